"""Example arguments for a tool's properties.

A rule is ``(condition, value, is_text)`` in SQL over ``p.name``, ``p.type`` and
``p.key``, the key that seeds every choice. ``value`` is a string: text to be
quoted, or JSON as it is. The first rule whose condition holds wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from toolloom import fixed_values as fixed
from toolloom.functions import hashing, jsonx, sql

Rule = tuple[str, str, bool]

_KEY = "p.key"


def named(name: str, value: str, is_text: bool = True) -> Rule:
    return f"p.name = {sql.literal(name)}", value, is_text


def typed(kind: str, value: str, is_text: bool = False) -> Rule:
    return f"p.type = {sql.literal(kind)}", value, is_text


def _string(number: str) -> str:
    return f"CAST({number} AS STRING)"


RULES: list[Rule] = [
    named("$filter", f"array_join({hashing.sample(fixed.FILTER_CLAUSES, 1, 2, _KEY)}, ' and ')"),
    named("$select", f"array_join({hashing.sample(fixed.SELECT_FIELDS, 2, 4, _KEY)}, ',')"),
    named("$top", _string(hashing.pick(fixed.TOP_SIZES, _KEY)), is_text=False),
    named(
        "$orderby",
        f"concat({hashing.pick(fixed.ORDER_FIELDS, _KEY)}, ' ', {hashing.pick(fixed.ORDER_DIRECTIONS, _KEY, 'direction')})",
    ),
    named("$expand", hashing.pick(fixed.EXPANSIONS, _KEY)),
    named("$search", f"concat('\"', {hashing.pick(fixed.SEARCH_TERMS, _KEY)}, '\"')"),
    named("alertId", f"concat({hashing.uuid_text(_KEY)}, '_', {hashing.pick_int(10_000_000, 99_999_999, _KEY)})"),
    named("incidentId", _string(hashing.pick_int(1000, 999_999, _KEY))),
    named(
        "userId",
        f"concat({hashing.pick(fixed.USER_NAMES, _KEY)}, '@', {hashing.pick(fixed.USER_DOMAINS, _KEY, 'domain')})",
    ),
    named(
        "hostName",
        f"concat({hashing.pick(fixed.HOST_PREFIXES, _KEY)}, '-', "
        f"lpad({_string(hashing.pick_int(1, 99, _KEY, 'number'))}, 2, '0'))",
    ),
    named("query", hashing.pick(fixed.HUNTING_QUERIES, _KEY)),
    named("timeRange", hashing.pick(fixed.TIME_RANGES, _KEY)),
    typed("integer", _string(hashing.pick_int(1, 100, _KEY))),
    typed("boolean", f"CASE WHEN {hashing.hash32(_KEY)} % 2 = 0 THEN 'true' ELSE 'false' END"),
    typed(
        "array",
        jsonx.json_list(
            f"transform(sequence(0L, {hashing.pick_int(0, 2, _KEY)}), i -> concat('\"item', i, '\"'))"
        ),
    ),
    typed("object", "'{}'"),
    ("true", f"concat('example_', p.name, '_', {hashing.pick_int(100, 999, _KEY)})", True),
]


def example_args_json(properties: str, op_key: str, seed: int, rules: Sequence[Rule] = RULES) -> str:
    """SQL of a JSON object text with one argument per property."""
    keyed = (
        f"transform({properties}, p -> struct(p.name AS name, p.type AS type, "
        f"concat_ws('|', '{seed}', {op_key}, p.name) AS key))"
    )
    value = "CASE " + " ".join(f"WHEN {c} THEN {v}" for c, v, _ in rules) + " END"
    is_text = "CASE " + " ".join(f"WHEN {c} THEN {str(t).lower()}" for c, _, t in rules) + " END"
    valued = f"transform({keyed}, p -> struct(p.name AS name, {value} AS value, {is_text} AS is_text))"
    argument = f"CASE WHEN a.is_text THEN {jsonx.quote('a.value')} ELSE a.value END"
    return jsonx.json_object(f"transform({valued}, a -> {jsonx.member('a.name', argument)})")
