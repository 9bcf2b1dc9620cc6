"""Keyword routing of a request to a tool key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from toolloom import fixed_values as fixed


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """Substring test against each word; words that contain another are redundant."""
    needed = [w for w in dict.fromkeys(words) if not any(o != w and o in w for o in words)]
    return reduce(lambda a, b: a | b, [text.contains(w) for w in needed])


def route_tool(
    request: Column, routes: Sequence[tuple] = fixed.ROUTES, default: str = fixed.DEFAULT_ROUTE
) -> Column:
    """Tool key of the first rule whose words occur in the lower-cased request."""
    text = F.lower(request)
    chain = F
    for words, narrower, key in routes:
        hit = contains_any(text, words)
        for sub_words, sub_key in narrower:
            chain = chain.when(hit & contains_any(text, sub_words), sub_key)
        chain = chain.when(hit, key)
    return F.lit(default) if chain is F else chain.otherwise(default)
