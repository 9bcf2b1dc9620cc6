"""Tool definitions from parsed operations, as SQL over ``op``, ``method`` and ``path``."""

from __future__ import annotations

from toolloom import fixed_values as fixed
from toolloom.functions import sql
from toolloom.functions.jsonx import json_list, json_object, member, quote, variant_kind_sql
from toolloom.functions.text import clean_text_sql

# The operation id, or the method and path with _ for /.
NAME = "coalesce(op.operationId, concat(method, '_', replace(path, '/', '_')))"

DESCRIPTION = clean_text_sql("coalesce(op.summary, op.description)")

# Headers, cookies and references drop out.
USABLE_PARAMETERS = (
    "filter(coalesce(op.parameters, array()), "
    f"p -> p.in IN ({', '.join(sql.literal(x) for x in fixed.PARAMETER_LOCATIONS)}) AND p.name IS NOT NULL)"
)

_FALSE_JSON = ", ".join(sql.literal(x) for x in ("false", "null", "0", "0.0", '""', "[]", "{}"))


def required(usable: str) -> str:
    """Names of the required parameters in order; a repeated one repeats."""
    return f"filter({usable}, p -> coalesce(to_json(p.required) NOT IN ({_FALSE_JSON}), false)).name"


def _type_json(kind: str) -> str:
    """A type is nearly always a name; in newer specs it may be a list of names."""
    names = f"try_variant_get({kind}, '$', 'array<string>')"
    return (
        f"CASE {variant_kind_sql(kind)} WHEN 'string' THEN {quote(f'CAST({kind} AS STRING)')} "
        f"WHEN 'array' THEN {json_list(f'transform({names}, t -> {quote("t")})')} "
        f"ELSE coalesce(to_json({kind}), '\"string\"') END"
    )


def properties(usable: str) -> str:
    """ARRAY<STRUCT<name, type, type_json, description>>, with one more for a JSON body."""
    listed = (
        f"transform({usable}, p -> struct(p.name AS name, "
        "coalesce(try_variant_get(p.schema.type, '$', 'string'), 'string') AS type, "
        f"{_type_json('p.schema.type')} AS type_json, {clean_text_sql('p.description')} AS description))"
    )
    body = (
        f"struct({sql.literal(fixed.BODY_PROPERTY)} AS name, 'object' AS type, '\"object\"' AS type_json, "
        f"{sql.literal(fixed.BODY_DESCRIPTION)} AS description)"
    )
    has_body = "coalesce(map_contains_key(op.requestBody.content, 'application/json'), false)"
    return f"concat({listed}, CASE WHEN {has_body} THEN array({body}) ELSE array() END)"


def last_of_each_name(listed: str) -> str:
    """A repeated name keeps its first place and its last value."""
    kept = f"transform(array_distinct({listed}.name), n -> element_at(filter({listed}, q -> q.name = n), -1))"
    return f"CASE WHEN size(array_distinct({listed}.name)) = size({listed}) THEN {listed} ELSE {kept} END"


def definition(name: str, description: str, properties: str, required: str) -> str:
    """JSON text of a tool definition."""
    entry = member(
        "p.name", f"concat('{{\"type\": ', p.type_json, ', \"description\": ', {quote('p.description')}, '}}')"
    )
    return (
        f"concat('{{\"type\": \"function\", \"function\": {{\"name\": ', {quote(name)}, "
        f"', \"description\": ', {quote(description)}, ', \"parameters\": {{\"type\": \"object\", \"properties\": ', "
        f"{json_object(f'transform({properties}, p -> {entry})')}, ', \"required\": ', "
        f"{json_list(f'transform({required}, r -> {quote("r")})')}, '}}}}}}')"
    )


def call(name: str, arguments: str) -> str:
    """JSON text of a tool call; ``arguments`` is JSON text already."""
    return f"concat('{{\"name\": ', {quote(name)}, ', \"arguments\": ', {arguments}, '}}')"
