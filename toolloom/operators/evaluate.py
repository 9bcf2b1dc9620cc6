"""Scoring of generated tool calls against expected ones.

Everything here is a projection: no shuffle, no Python workers. Only pairing
samples with predictions joins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from toolloom.functions import jsonx, sql
from toolloom.functions.jsonx import variant_kind, variant_kind_sql
from toolloom.operators.samples import SAMPLE_ORDER
from toolloom.sources.scratch import written

CONTAINERS = ("object", "array")
# Rows that a top-n sort may bring together in one task.
SMALL = 10_000
_MAP = "map<string,variant>"


def take_first(df: DataFrame, n: int | None, order_col: str | list[str], dense: bool = False) -> DataFrame:
    """The first ``n`` rows by ``order_col``, one column or several; None or 0 keeps all.

    With a ``dense`` order column (0, 1, 2, ... as the sample reader numbers
    rows) this is a filter. Up to ``SMALL`` rows are a top-n sort, in which a task
    keeps no more than these. Beyond that the n-th key is looked up (see
    :func:`_upto`) and rows are compared with it; they come in no order.
    """
    if not n:
        return df
    order = [order_col] if isinstance(order_col, str) else list(order_col)
    if dense:
        return df.where(F.col(order[0]) < n)
    return df.orderBy(*order).limit(n) if n <= SMALL else _upto(df, n, order)


def _upto(df: DataFrame, n: int, order: list[str]) -> DataFrame:
    """First n rows without any task that sorts them all.

    The keys alone are dealt into ranges and written. The ranges' sizes tell in which the
    n-th key is, and only that range is ranked. Rows before that key are in; of
    those with the very same key as many as are still wanted.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct(*[F.col(sql.name(c)) for c in order])
    keys = written(df.select(key.alias("key")).repartitionByRange(ranges, "key").withColumn("piece", F.spark_partition_id()))
    rest = n
    for piece, size in sorted(tuple(r) for r in keys.groupBy("piece").count().collect()):  # one row a range
        if rest <= size:
            break
        rest -= size
    else:
        return df
    ranked = keys.where(F.col("piece") == piece).withColumn("rank", F.row_number().over(Window.partitionBy("piece").orderBy("key")))
    first_alike = ranked.withColumn("alike", F.min("rank").over(Window.partitionBy("piece", "key")))
    # the n-th key and how many rows with that very key are wanted
    border = first_alike.where(F.col("rank") == rest).select(F.struct("key", (F.col("rank") - F.col("alike") + 1).alias("wanted")).alias("border"))
    known = df.withColumn("_key", key).withColumn("_border", border.scalar())
    sooner = known.where(F.col("_key") < F.col("_border.key"))
    alike = known.where(F.col("_key") == F.col("_border.key"))
    chosen = alike.withColumn("_rank", F.row_number().over(Window.partitionBy("_key").orderBy("_key"))).where(F.col("_rank") <= F.col("_border.wanted"))
    return sooner.select(*df.columns).unionByName(chosen.select(*df.columns))


def ranked_predictions(predictions: DataFrame) -> tuple[list[str], Column]:
    """The columns of an answer that are there, and a struct of which the least is the answer that counts.

    One without an error comes first, then one with a text, then by text, time and tokens.
    """
    wanted = [c for c in ("generated", "inference_time", "num_tokens", "error") if c in predictions.columns]
    worse = [F.col(c).isNotNull() if c == "error" else F.col(c).isNull() for c in ("error", "generated") if c in wanted]
    ranks = [w.alias(f"_worse{i}") for i, w in enumerate(worse)]
    return wanted, F.struct(*ranks, *wanted) if wanted else F.struct(F.lit(True).alias("_found"))


def pair_predictions(samples: DataFrame, predictions: DataFrame, key: str = "sample_id") -> DataFrame:
    """Each sample with its prediction; one that is missing is an error row.

    Of several predictions for one sample the best by :func:`ranked_predictions` counts.
    """
    wanted, rank = ranked_predictions(predictions)
    one = predictions.groupBy(key).agg(F.min(rank).alias("_one"))
    found = one.select(F.col(key), F.lit(True).alias("_found"), *[F.col(f"_one.{c}") for c in wanted])
    return with_missing(samples.withColumnRenamed("output", "expected").join(found, key, "left"), "error" in wanted)


def with_missing(paired: DataFrame, has_error: bool) -> DataFrame:
    """Samples without a prediction (``_found`` is null) as error rows."""
    given = F.col("error") if has_error else F.lit(None).cast("string")
    error = F.when(F.col("_found").isNull(), "missing_prediction").otherwise(given)
    return paired.withColumn("error", error).drop("_found")


def compare_tool_calls(df: DataFrame, generated: str = "generated", expected: str = "expected") -> DataFrame:
    """Add ``is_valid_json``, ``name_matches``, ``arguments_match`` and ``compare_error``.

    The two match columns are NULL when there is nothing to compare, that is
    when a side is not JSON or is ``null``, and when comparing is an error.
    Arguments match when every expected key is there and a list or object meets
    its own kind; scalar values are not compared and more keys may be there.
    """
    jsonx.keep_last_of_repeated_keys(df.sparkSession)
    judged = _with_verdict(_with_parts(df, generated, expected), generated, expected)
    # As a generated row the verdict is computed once: a later filter on it is
    # not pushed into the projections above, which would parse again for it.
    scored = judged.select(*df.columns, F.inline(F.array(F.struct("_valid", "_same_name", "_code"))))
    return scored.select(
        *df.columns,
        F.col("_valid").alias("is_valid_json"),
        F.when(F.col("_code").isin("ok", "miss"), F.col("_same_name")).alias("name_matches"),
        F.when(F.col("_code").isin("ok", "miss"), F.col("_code") == "ok").alias("arguments_match"),
        F.when(~F.col("_code").isin("ok", "miss", "nothing"), F.col("_code")).alias("compare_error"),
    )


def evaluate_samples(pairs: DataFrame, generated: str = "generated", expected: str = "expected") -> DataFrame:
    """Add ``is_valid_json``, ``name_correct``, ``arguments_correct`` and ``error``.

    A row that comes with an ``error`` keeps it and scores nothing. Missing
    ``inference_time`` and ``num_tokens`` count as zero.
    """
    given = F.col("error") if "error" in pairs.columns else F.lit(None).cast("string")
    seconds = F.col("inference_time") if "inference_time" in pairs.columns else F.lit(None)
    tokens = F.col("num_tokens") if "num_tokens" in pairs.columns else F.lit(None)
    own = ("error", "inference_time", "num_tokens")
    compared = compare_tool_calls(pairs.withColumn("_given", given), generated, expected)
    fine = F.col("_given").isNull()
    name = fine & F.coalesce(F.col("name_matches"), F.lit(False))
    return compared.select(
        *[c for c in pairs.columns if c not in own],
        (fine & F.col("is_valid_json")).alias("is_valid_json"),
        name.alias("name_correct"),
        (name & F.coalesce(F.col("arguments_match"), F.lit(False))).alias("arguments_correct"),
        F.coalesce(seconds.cast("double"), F.lit(0.0)).alias("inference_time"),
        F.coalesce(tokens.cast("bigint"), F.lit(0)).alias("num_tokens"),
        F.coalesce("_given", "compare_error").alias("error"),
    )


def evaluate_dataset(
    samples: DataFrame,
    predictions: DataFrame,
    max_samples: int | None = None,
    key: str = "sample_id",
    order_col: str | list[str] | None = None,
    dense: bool = False,
) -> DataFrame:
    """First samples, paired and scored; metrics are computed from the result.

    Harvested samples come in the order of their documents, others in that of
    the key, unless told otherwise.
    """
    harvested = all(c in samples.columns for c in SAMPLE_ORDER)
    first = take_first(samples, max_samples, order_col or (SAMPLE_ORDER if harvested else key), dense)
    return evaluate_samples(pair_predictions(first, predictions, key))


def evaluate_single(
    spark: SparkSession, query: str, tool_json: str, make_predictor: Callable, **options
) -> DataFrame:
    """One query through the predictor: response, readable text and verdict."""
    from toolloom.operators.chat import prompt_column
    from toolloom.operators.inference import generate_tool_calls

    one = spark.createDataFrame([(query, tool_json)], "query STRING, tool STRING")
    prompted = one.withColumn("prompt", prompt_column(F.col("query"), F.col("tool")))
    answered = generate_tool_calls(prompted, make_predictor, **options)
    valid = F.col("parsed").isNotNull()
    pretty = F.to_json("parsed", {"pretty": "true"})
    return answered.select(
        "query",
        F.get_json_object("tool", "$.function.name").alias("tool_name"),
        F.when(valid, pretty).otherwise(F.col("generated")).alias("response"),
        F.when(valid, "[Valid JSON]").otherwise("[Invalid JSON]").alias("verdict"),
        "inference_time",
        "num_tokens",
        "error",
    )


def _with_parts(df: DataFrame, generated: str, expected: str) -> DataFrame:
    """Each text parsed once, and the parts that most rows need.

    ``_g`` and ``_e`` stand for the generated and expected side: the whole value,
    its name as JSON text and its arguments as a map, NULL unless an object.
    """
    sides = {"_g": F.col(generated), "_e": F.col(expected)}
    parsed = df.select("*", *[jsonx.parsed_array(t).alias(f"{s}_all") for s, t in sides.items()])
    whole = parsed.select(
        *df.columns,
        *[jsonx.whole_value(F.col(f"{s}_all"), t).alias(s) for s, t in sides.items()],
    )
    return whole.select(
        "*",
        *[F.try_variant_get(F.col(s), "$.arguments", _MAP).alias(f"{s}_map") for s in sides],
        *[F.to_json(F.try_variant_get(F.col(s), "$.name", "variant")).alias(f"{s}_name") for s in sides],
    )


def _with_verdict(parts: DataFrame, generated: str, expected: str) -> DataFrame:
    """``_valid``, ``_same_name`` and ``_code``.

    The code is ok or miss for the arguments, nothing when there is nothing to
    compare, or what went wrong.
    """
    g_text, e_text = F.col(generated), F.col(expected)
    g_readable, e_readable = F.col("_g").isNotNull(), F.col("_e").isNotNull()
    g_kind, e_kind = jsonx.root_kind(g_text), jsonx.root_kind(e_text)
    # Only texts that did not parse as a whole are looked at a second time.
    valid = F.when(g_readable, True).otherwise(jsonx.is_valid_json(g_text))
    e_valid = F.when(e_readable, True).otherwise(jsonx.is_valid_json(e_text))
    code = (
        F.when(F.col("_g_map").isNotNull() & F.col("_e_map").isNotNull(), _object_code())
        .when(g_text.isNull(), "null_text")
        .when(~F.col("_valid") | (g_kind == "null"), "nothing")
        .when(e_text.isNull(), "null_expected")
        .when((e_kind == "null") | ~e_valid, "nothing")
        .when(~g_readable, "unreadable")
        .when(g_kind != "object", "not_object")
        .when(~e_readable, "expected_unreadable")
        .when(e_kind != "object", "expected_not_object")
        .otherwise(_argument_code(e_text))
    )
    return parts.select("*", valid.alias("_valid")).select("*", _same_name().alias("_same_name"), code.alias("_code"))


def _same_name() -> Column:
    """A missing name is an empty one. Numbers and booleans are equal by value; NaN equals nothing."""
    given, wanted = [F.coalesce(F.col(f"{s}_name"), F.lit('""')) for s in ("_g", "_e")]
    kinds = [F.expr(variant_kind_sql(_part(s, "$.name"))) for s in ("_g", "_e")]
    texts_only = (kinds[0] != "number") & (kinds[1] != "number")
    numbers = [
        F.when(t == "true", 1.0).when(t == "false", 0.0).otherwise(t.try_cast("double")) for t in (given, wanted)
    ]
    return (
        F.when((given == wanted) & (given == '"NaN"'), texts_only)
        .when(given == wanted, True)
        .otherwise(F.coalesce(numbers[0] == numbers[1], F.lit(False)))
    )


def _part(side: str, path: str) -> str:
    return f"try_variant_get({side}, '{path}', 'variant')"


def _args_kind(side: str) -> Column:
    """No arguments at all are the same as an empty object."""
    return F.expr(f"coalesce({variant_kind_sql(_part(side, '$.arguments'))}, 'object')")


def _argument_code(expected: Column) -> Column:
    """Verdict on two objects when not both of them hold an argument object."""
    wanted_kind, given_kind = _args_kind("_e"), _args_kind("_g")
    text = F.expr("try_variant_get(_e, '$.arguments', 'string')")
    item = F.expr("try_variant_get(_e, '$.arguments[0]', 'string')")
    first = F.when(wanted_kind == "string", F.substring(text, 1, 1)).otherwise(item)
    first_kind = F.expr(variant_kind_sql(_part("_e", "$.arguments[0]")))
    return (
        F.when(~wanted_kind.isin("object", "string", "array"), "expected_args_not_iterable")
        .when(
            wanted_kind == "object",
            F.when(F.coalesce(F.size(F.col("_e_map")), F.lit(0)) == 0, "ok")
            .when(given_kind == "object", "miss")
            .when(given_kind.isin("array", "string"), _ordered_code(expected))
            .otherwise("args_not_container"),
        )
        # Expected arguments that are text or a list are gone through by
        # character or item, and the first one already decides.
        .when(
            (wanted_kind == "string") & (F.coalesce(F.length(first), F.lit(0)) == 0)
            | (wanted_kind == "array") & first_kind.isNull(),
            "ok",
        )
        .when(~given_kind.isin("object", "array", "string"), "args_not_container")
        .when(
            (wanted_kind == "string") | (first_kind == "string"),
            F.when(_has(first), "expected_args_not_object").otherwise("miss"),
        )
        .when((given_kind == "object") & ~first_kind.isin(*CONTAINERS), "miss")
        .otherwise("expected_args_not_object")
    )


def _has(key: Column) -> Column:
    """Whether the generated arguments contain a key, item or piece of text."""
    kind = _args_kind("_g")
    items = F.expr("coalesce(try_variant_get(_g, '$.arguments', 'array<variant>'), array())")
    return (
        F.when(kind == "object", F.coalesce(F.map_contains_key(F.col("_g_map"), key), F.lit(False)))
        .when(
            kind == "array",
            F.exists(items, lambda v: (variant_kind(v) == "string") & (F.try_variant_get(v, "$", "string") == key)),
        )
        .otherwise(F.expr("try_variant_get(_g, '$.arguments', 'string')").contains(key))
    )


def _object_code() -> Column:
    """Both sides hold an argument object: no expected key is missing or of another kind."""
    wanted, given = F.col("_e_map"), F.col("_g_map")

    def bad(entry: Column) -> Column:
        kind = variant_kind(entry["value"])
        other = kind.isin(*CONTAINERS) & (variant_kind(F.try_element_at(given, entry["key"])) != kind)
        return ~F.map_contains_key(given, entry["key"]) | other

    return F.when(F.exists(F.map_entries(wanted), bad), "miss").otherwise("ok")


def _ordered_code(expected: Column) -> Column:
    """Generated arguments are a list or text: the first bad key decides, as written.

    VARIANT sorts keys, so their order comes from the text; only these rows
    read it again.
    """
    members = F.from_json(expected, "map<string,string>", jsonx.OPTIONS)
    inner = F.from_json(jsonx.last_value(members, "arguments"), "map<string,string>", jsonx.OPTIONS)

    def code(key: Column) -> Column:
        is_container = variant_kind(F.try_element_at(F.col("_e_map"), key)).isin(*CONTAINERS)
        return F.when(~_has(key), "miss").when(is_container, "container_lookup").otherwise("ok")

    codes = F.transform(F.array_distinct(F.map_keys(inner)), code)
    return F.coalesce(F.try_element_at(F.filter(codes, lambda c: c != "ok"), F.lit(1)), F.lit("ok"))
