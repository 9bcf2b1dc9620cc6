"""Keyed choices as SQL: the same key gives the same value on any partitioning.

``key`` is SQL of a string. A salt separates choices made with one key.
"""

from __future__ import annotations

from collections.abc import Sequence

from toolloom.functions import sql

HASH_RANGE = 1 << 32


def salted(key: str, salt: str | None) -> str:
    return key if salt is None else f"concat({key}, {sql.literal('|' + salt)})"


def hash32(key: str, salt: str | None = None) -> str:
    """First 32 bits of the md5, as a bigint."""
    return f"CAST(conv(substring(md5({salted(key, salt)}), 1, 8), 16, 10) AS BIGINT)"


def pick(values: Sequence[str | int], key: str, salt: str | None = None) -> str:
    """One of ``values``."""
    return f"element_at({sql.array(values)}, CAST({hash32(key, salt)} % {len(values)} + 1 AS INT))"


def pick_int(low: int, high: int, key: str, salt: str | None = None) -> str:
    """An integer from ``low`` to ``high``, both included."""
    return f"({hash32(key, salt)} % {high - low + 1} + {low})"


def sample(values: Sequence[str], low: int, high: int, key: str) -> str:
    """Array of between ``low`` and ``high`` distinct members of ``values``, in random order."""
    ranked = f"transform({sql.array(values)}, v -> struct(md5(concat({key}, '|', v)) AS rank, v AS value))"
    count = f"CAST({pick_int(low, high, key, 'count')} AS INT)"
    return f"slice(array_sort({ranked}).value, 1, {count})"


def uuid_text(key: str) -> str:
    """A version-4 shaped UUID."""
    hexes = f"md5({salted(key, 'uuid')})"
    variant = f"substring('89ab', CAST({hash32(key, 'variant')} % 4 + 1 AS INT), 1)"
    return (
        f"concat(substring({hexes}, 1, 8), '-', substring({hexes}, 9, 4), '-4', substring({hexes}, 14, 3), '-', "
        f"{variant}, substring({hexes}, 18, 3), '-', substring({hexes}, 21, 12))"
    )
