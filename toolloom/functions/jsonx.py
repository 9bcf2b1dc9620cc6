"""JSON validity, parsing and writing with Python's rules.

Spark's JSON parsers stop after the first value, so ``{"a":1} x`` parses. Here
the text is wrapped as ``[text,hash(text)]``: the second element can only be the
text's own hash when the first one is exactly the whole text. One parse
therefore gives both the verdict and the value.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from toolloom.functions import sql
from toolloom.functions.text import strip

OPTIONS = {
    "allowSingleQuotes": "false",
    "allowUnquotedControlChars": "false",
    "allowNonNumericNumbers": "true",
    # Spark's reader stops at 1,000 digits and 100,000,000 characters by default.
    "maxNumLen": str(2**31 - 1),
    "maxStringLen": str(2**31 - 1),
}
_STRICT = {**OPTIONS, "allowNonNumericNumbers": "false"}
# Spark's reader gives up at 1,000 levels; a text of fewer brackets has fewer levels.
_DEPTH_LIMIT = 1000
_JSON_BLANKS = " \t\n\r"
_STRINGS = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def keep_last_of_repeated_keys(spark: SparkSession) -> None:
    """Let VARIANT take objects with a repeated key, the last one winning.

    A runtime SQL setting, so it has to be on when the plan runs; the operators
    that need it call this. Without it such rows are reported as errors.
    """
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def _wrap(text: Column) -> Column:
    return F.concat(F.lit("["), text, F.lit(","), F.xxhash64(text).cast("string"), F.lit("]"))


def _spelled_infinity(text: Column) -> Column:
    """Spark also takes INF and signed forms as numbers; Python does not."""
    suspicious = text.contains("INF") | text.contains("+Inf")
    bare = F.regexp_replace(text, _STRINGS, '""')
    return suspicious & bare.rlike(r"[+-]?INF|\+Inf")


def _is_deep_json(text: Column, options: dict[str, str]) -> Column:
    """The verdict on a text of any depth, from a parse that skips its values instead of copying them.

    The text stands once as an object's member and once as an array's first element. What would end or continue
    the one (``1},{``, ``1,"k":2``) is an error in the other, so both can only be read over if it is one value.
    """
    twice = F.concat(F.lit('{"member":'), text, F.lit(',"element":['), text, F.lit(',0],"mark":"'), F.xxhash64(text).cast("string"), F.lit('"}'))
    parsed = F.from_json(twice, "mark string", options | {"maxNestingDepth": str(2**31 - 1)})
    return parsed["mark"] == F.xxhash64(text).cast("string")


def is_valid_json(text: Column, mode: str = "python") -> Column:
    """True when the whole text is one JSON value, however deep; NULL text is not.

    ``python`` accepts NaN and the infinities, ``strict`` does not. Only a text that the first
    parse gave up on and that has brackets enough to be too deep for it is parsed again.
    """
    if mode not in ("python", "strict"):
        raise ValueError(f"unknown mode: {mode}")
    options = OPTIONS if mode == "python" else _STRICT
    parsed = F.from_json(_wrap(text), "array<string>", options)
    whole = F.coalesce(F.get(parsed, F.lit(1)) == F.xxhash64(text).cast("string"), F.lit(False))
    brackets = F.length(text) - F.length(F.translate(text, "[{", ""))
    whole = F.when(whole, True).when(brackets >= _DEPTH_LIMIT - 2, _is_deep_json(text, options)).otherwise(False)
    if mode == "python":
        whole = whole & ~_spelled_infinity(text)
    return F.coalesce(whole, F.lit(False))


def parsed_array(text: Column) -> Column:
    """ARRAY<VARIANT> to give to :func:`whole_value`; project it once."""
    return F.from_json(_wrap(text), "array<variant>", OPTIONS)


def whole_value(parsed: Column, text: Column) -> Column:
    """VARIANT of the text, or NULL when the text is not one JSON value."""
    mark = F.try_variant_get(F.get(parsed, F.lit(1)), "$", "bigint")
    whole = (mark == F.xxhash64(text)) & ~_spelled_infinity(text)
    return F.when(whole, F.get(parsed, F.lit(0)))


_KINDS = "map('OB', 'object', 'AR', 'array', 'VO', 'null', 'ST', 'string', 'BO', 'boolean')"


def variant_kind(value: Column) -> Column:
    """object, array, null, string, boolean or number; NULL for NULL."""
    known = F.try_element_at(F.expr(_KINDS), F.substring(F.schema_of_variant(value), 1, 2))
    return F.when(value.isNotNull(), F.coalesce(known, F.lit("number")))


def variant_kind_sql(value: str) -> str:
    known = f"try_element_at({_KINDS}, substring(schema_of_variant({value}), 1, 2))"
    return f"CASE WHEN {value} IS NOT NULL THEN coalesce({known}, 'number') END"


def root_kind(text: Column) -> Column:
    """Kind of a valid JSON text by its first character: object, array, null or other."""
    first = F.substring(F.btrim(text, F.lit(_JSON_BLANKS)), 1, 1)
    return F.when(first == "{", "object").when(first == "[", "array").when(first == "n", "null").otherwise("other")


def last_value(entries: Column, key: str) -> Column:
    """Value of the last occurrence of ``key`` in a map that may repeat keys."""
    place = F.array_position(F.reverse(F.map_keys(entries)), F.lit(key))
    return F.get(F.reverse(F.map_values(entries)), (place - 1).cast("int"))


def parse_response(text: Column) -> Column:
    """STRUCT<parsed VARIANT, raw STRING> of a stripped model response.

    ``parsed`` is NULL when the text is not JSON; the raw text is always kept.
    """
    raw = strip(text)
    return F.struct(whole_value(parsed_array(raw), raw).alias("parsed"), raw.alias("raw"))


_SHORT_ESCAPES = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\f": "\\f", "\b": "\\b"}
_ESCAPES = f"map({', '.join(sql.literal(x) for pair in _SHORT_ESCAPES.items() for x in pair)})"
_UNITS = f"regexp_replace(lower(hex(encode(c, 'UTF-16BE'))), '(.{{4}})', {sql.literal(chr(92) * 2 + 'u$1')})"
_ESCAPE = f"CASE WHEN c BETWEEN ' ' AND '~' THEN coalesce(try_element_at({_ESCAPES}, c), c) ELSE coalesce(try_element_at({_ESCAPES}, c), {_UNITS}) END"
_PLAIN = sql.literal(r"^[ !#-\[\]-~]*$")


def quote(text: str) -> str:
    """SQL of a JSON string literal, all non-ASCII characters escaped."""
    escaped = f"array_join(transform(split({text}, ''), c -> {_ESCAPE}), '')"
    return f"concat('\"', CASE WHEN {text} RLIKE {_PLAIN} THEN {text} ELSE {escaped} END, '\"')"


def json_list(items: str) -> str:
    """SQL of a JSON array text from an array of JSON texts."""
    return f"concat('[', array_join({items}, ', '), ']')"


def json_object(members: str) -> str:
    """SQL of a JSON object text from an array of ``"key": value`` texts."""
    return f"concat('{{', array_join({members}, ', '), '}}')"


def member(key: str, value: str) -> str:
    return f"concat({quote(key)}, ': ', {value})"
