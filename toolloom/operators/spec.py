"""From spec documents to operations and tool definitions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolloom import fixed_values as fixed
from toolloom import schemas
from toolloom.functions import tools
from toolloom.functions.routing import contains_any
from toolloom.functions.jsonx import OPTIONS
from toolloom.functions.text import clean_text, strip
from toolloom.operators.patterns import filter_patterns

# Characters from which on the paths of a document are spread.
LARGE_SPEC = 1_000_000


def filter_namespaces(df: DataFrame, namespaces: Sequence[str] | DataFrame | None = None) -> DataFrame:
    """Keep rows whose ``path`` contains a namespace; an empty list keeps all.

    A list becomes one expression. A table with a column ``namespace`` may be of any
    size: see :func:`toolloom.operators.patterns.match_patterns`.
    """
    if isinstance(namespaces, DataFrame):
        return filter_patterns(df, namespaces)
    wanted = fixed.TARGET_NAMESPACES if namespaces is None else list(namespaces)
    return df.where(contains_any(F.col("path"), wanted)) if wanted else df


def filter_methods(df: DataFrame, methods: Sequence[str] = fixed.VALID_METHODS) -> DataFrame:
    """Keep path-item keys that are operations, compared as written."""
    return df.where(F.col("method").isin(*methods))


def filter_has_summary(operations: DataFrame) -> DataFrame:
    """Keep operations whose cleaned summary is not empty."""
    return operations.where(clean_text("op.summary") != "")


def _judged(specs: DataFrame) -> DataFrame:
    """``_paths`` of each document and ``_error``, from one parse of the text wrapped together with its own hash."""
    wrapped = F.concat(F.lit('{"spec":'), F.col("content"), F.lit(',"mark":"'), F.xxhash64("content"), F.lit('"}'))
    parsed = specs.withColumn("_parsed", F.from_json(wrapped, schemas.WRAPPED_SPEC, OPTIONS))
    error = (
        F.when(F.col("content").isNull(), "missing")
        .when(~F.coalesce(F.col("_parsed.mark") == F.xxhash64("content").cast("string"), F.lit(False)), "not_json")
        .when(~strip(F.col("content")).startswith("{"), "not_an_object")
        .when(F.col("_parsed.spec").isNull(), "not_json")  # a broken object is skipped by the reader
    )
    # A generated row, so that a filter on the verdict is not pushed below: it would parse again, in the tasks of whatever reads the texts.
    return parsed.select(*specs.columns, F.col("_parsed.spec.paths").alias("_paths"), F.inline(F.array(F.struct(error.alias("_error")))))


def spec_rejects(specs: DataFrame) -> DataFrame:
    """``(spec_id, error)`` of documents that are no JSON object: missing, not_json or not_an_object."""
    return _judged(specs).where(F.col("_error").isNotNull()).select("spec_id", F.col("_error").alias("error"))


def _last_of_each_key(entries: str) -> str:
    """SQL of an array of (key, value): a repeated key keeps its first place and its last value."""
    plain = f"map_entries({entries})"
    kept = f"transform(array_distinct(map_keys({entries})), k -> element_at(filter({plain}, e -> e.key = k), -1))"
    return f"CASE WHEN size(array_distinct(map_keys({entries}))) = size({entries}) THEN {plain} ELSE {kept} END"


def spec_paths(specs: DataFrame, on_error: str = "raise") -> DataFrame:
    """``(spec_id, path_pos, path, item)``, the item as JSON text.

    A document that is no JSON object stops the query; with ``on_error="skip"``
    it has no paths, and :func:`spec_rejects` tells which these are.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError(f"unknown on_error: {on_error}")
    judged = _judged(specs)
    if on_error == "raise":
        stop = F.raise_error(F.concat(F.lit("unusable spec "), F.coalesce("spec_id", F.lit("")), F.lit(": "), F.col("_error")))
        judged = judged.withColumn("_paths", F.when(F.col("_error").isNotNull(), stop.cast("map<string,string>")).otherwise(F.col("_paths")))
    else:
        judged = judged.where(F.col("_error").isNull())
    entries = judged.select("spec_id", F.posexplode(F.expr(_last_of_each_key("_paths"))).alias("path_pos", "_entry"))
    return entries.select("spec_id", "path_pos", F.col("_entry.key").alias("path"), F.col("_entry.value").alias("item"))


def path_methods(paths: DataFrame) -> DataFrame:
    """One row per key of a path item, its value as JSON text."""
    items = paths.withColumn("_item", F.from_json("item", schemas.PATH_ITEM, OPTIONS))
    entries = items.select("spec_id", "path_pos", "path", F.posexplode(F.expr(_last_of_each_key("_item"))).alias("method_pos", "_entry"))
    return entries.select(
        "spec_id", "path_pos", "path", "method_pos", F.col("_entry.key").alias("method"), F.col("_entry.value").alias("op_json")
    )


def parse_operations(methods: DataFrame) -> DataFrame:
    """Replace ``op_json`` by the typed ``op``.

    A filter on one field is pushed below and parses that field alone, which
    is cheaper than carrying the whole parsed rows up to it.
    """
    typed = F.from_json("op_json", schemas.OPERATION, OPTIONS)
    # One parameter that is no object would take all with it: then each is read on its own.
    texts = F.from_json("op_json", "parameters ARRAY<STRING>", OPTIONS)["parameters"]
    each = F.transform(texts, lambda p: F.from_json(p, schemas.PARAMETER, OPTIONS))
    op = typed.withField("parameters", F.coalesce(typed["parameters"], F.filter(each, lambda p: p.isNotNull())))
    return methods.select("spec_id", "path_pos", "path", "method_pos", "method", op.alias("op"))


def spec_operations(
    specs: DataFrame,
    namespaces: Sequence[str] | DataFrame | None = None,
    methods: Sequence[str] = fixed.VALID_METHODS,
    spread: int | None = LARGE_SPEC,
    on_error: str = "raise",
) -> DataFrame:
    """Operations of a table of specs: ``(spec_id, path_pos, path, method_pos, method, op)``.

    Paths and methods are filtered while they are still text, before anything
    below them is parsed. A spec is one row, so a large document would leave all
    its work in one task: the paths of documents of more than ``spread``
    characters are dealt out over the cluster, to as many tasks as the session
    has shuffle partitions or the input has, whatever is more. The number is given to Spark, which
    would otherwise merge partitions by their size as text, long before prompts
    multiply it. Smaller documents stay where they are read. None spreads nothing.
    """
    def kept(some: DataFrame) -> DataFrame:
        return filter_namespaces(spec_paths(some, on_error), namespaces)

    if spread is None:
        paths = kept(specs)
    else:
        is_large = F.length("content") > spread
        setting = int(specs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        tasks = max(setting, specs.rdd.getNumPartitions())
        large = kept(specs.where(is_large)).repartition(tasks, "spec_id", "path_pos")
        paths = kept(specs.where(F.coalesce(~is_large, F.lit(True)))).unionByName(large)
    return parse_operations(filter_methods(path_methods(paths), methods))


def format_tools(operations: DataFrame) -> DataFrame:
    """Add the parts of the tool definition and ``input``, its JSON text."""
    usable = operations.selectExpr("*", f"{tools.USABLE_PARAMETERS} AS _usable")
    listed = usable.selectExpr(
        "*",
        f"{tools.NAME} AS tool_name",
        f"{tools.DESCRIPTION} AS description",
        f"{tools.properties('_usable')} AS _listed",
        f"{tools.required('_usable')} AS required",
    )
    named = listed.selectExpr(
        *operations.columns, "tool_name", "description", f"{tools.last_of_each_name('_listed')} AS properties", "required"
    )
    return named.selectExpr("*", f"{tools.definition('tool_name', 'description', 'properties', 'required')} AS input")
