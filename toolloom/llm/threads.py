"""Chat formatting by quotation linking: who answers whom, and the conversations in reply order without quotes.

A line that begins with > marks (white space between them allowed) is quoted, as deep as it has marks. Consecutive
lines of one depth are a passage; a passage and each of its lines get a hash of their characters, lower-cased, white space
collapsed. Quotes of every depth are joined to the messages that say the same unquoted: first of the own conversation, else of all; where several
say it, to the first of those that quote, before anything else, what the reply quotes one level deeper (its context), else to the first of all.
Of a message's quotes those of the least depth that found something count, so one whose outer quote was edited is linked to whom its inner
quote comes from. The message whose quoted characters are the most is the parent; of equal ones the first.
A parent always comes before its reply in the order of conversation, turn and row, so there are no circles.

Every message comes back with its thread (the root's conversation), depth, and path: the turns from the root down to it. Sorted by thread and
path, each reply stands behind what it answers. No conversation is gathered in one task; a passage that a third of all messages say or quote is
reduced to its first message before the join.

Null texts are empty messages; messages of quotes only have an empty text. Lines of nothing are no passages, and short ones (below LEAST_CHARS) are
matched only as a part of their passage. Very long messages are lines like any others. Null conversations and turns are values of their own, below all others.
Repeated rows are messages of their own, each with its own row. An empty table gives an empty result. Columns other than the named ones are not looked at. Main path: DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from toolloom.llm.common import stored

LEAST_CHARS = 8
_MARKS = "^(?:[ \\t]*>)+"


def _norm(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(text), "\\s+", " "))


def _lines(messages: DataFrame) -> DataFrame:
    """row, at, depth, line: every line of every message, without its marks."""
    line = F.col("raw")
    marks = F.regexp_extract(line, _MARKS, 0)
    split = messages.select("row", F.posexplode(F.split("text", "\r?\n")).alias("at", "raw"))
    depth = F.length(marks) - F.length(F.translate(marks, ">", ""))
    return split.select("row", "at", depth.alias("depth"), F.when(depth > 0, F.regexp_replace(line, _MARKS + "[ \\t]?", "")).otherwise(line).alias("line"))


def _passages(lines: DataFrame) -> DataFrame:
    """row, depth, hash, chars, context: of the passages and of their lines; distinct within a message.

    context is the hash of the first passage of the next greater depth that the message has.
    """
    by_message = Window.partitionBy("row").orderBy("at")
    begins = (F.col("depth") != F.lag("depth", 1, -1).over(by_message)).cast("int")
    numbered = lines.withColumn("begins", begins).withColumn("passage", F.sum("begins").over(by_message))
    whole = numbered.groupBy("row", "passage", "depth").agg(F.array_sort(F.collect_list(F.struct("at", "line"))).alias("lines"))
    joined = whole.select("row", "passage", "depth", F.transform("lines", lambda x: x["line"]).alias("lines"))
    text = joined.select("row", "passage", "depth", _norm(F.array_join("lines", " ")).alias("norm")).where("norm <> ''")
    own = stored(text.select("row", "passage", "depth", F.xxhash64("norm").alias("hash"), F.length("norm").alias("chars")))
    single = joined.select("row", "depth", F.explode("lines").alias("line")).select("row", "depth", _norm(F.col("line")).alias("norm")).where(F.length("norm") >= LEAST_CHARS)
    firsts = own.groupBy("row", "depth").agg(F.min(F.struct("passage", "hash"))["hash"].alias("first"))
    contexts = firsts.select("row", "depth", F.lead("first").over(Window.partitionBy("row").orderBy("depth")).alias("context")).where("context is not null")
    every = own.select("row", "depth", "hash", "chars").unionByName(single.select("row", "depth", F.xxhash64("norm").alias("hash"), F.length("norm").alias("chars")))
    return every.distinct().join(contexts, ["row", "depth"], "left")


def link(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages with quote counts and own text, links (row, parent)). messages: row, conv, turn, role, text; stored."""
    lines = stored(_lines(messages))
    own = lines.where("depth = 0").groupBy("row").agg(F.array_sort(F.collect_list(F.struct("at", "line"))).alias("lines"))
    plain = own.select("row", F.trim(F.array_join(F.transform("lines", lambda x: x["line"]), "\n"), F.lit(" \t\r\n")).alias("own_text"))
    quoting = lines.where("depth > 0").select("row").distinct()
    passages = stored(_passages(lines))
    asked = passages.where("depth > 0")
    where_ = messages.select("row", "conv", "turn")
    place = F.struct("conv", "turn", "row")
    said = stored(passages.where("depth = 0").select("row", "hash", "context").join(asked.select("hash").distinct(), "hash", "left_semi").join(where_, "row").select("hash", "conv", "context", place.alias("by")))
    found = asked.join(where_, "row").withColumn("place", place)
    for name, keys in (("in_thread", ["conv", "context"]), ("inside", ["conv"]), ("in_context", ["context"]), ("outside", [])):
        first = said.groupBy("hash", *keys).agg(F.min("by").alias(name))
        if "context" in keys:
            first = first.where("context is not null")
        side = first.withColumnsRenamed({k: f"said_{k}" for k in ["hash", *keys]})
        same = F.col("hash") == F.col("said_hash")
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"said_{k}"))
        found = found.join(side, same & (F.col(name) < F.col("place")), "left").drop(*[f"said_{k}" for k in ["hash", *keys]])
    found = found.select("row", "depth", "chars", F.coalesce("in_thread", "inside", "in_context", "outside").alias("parent")).where("parent is not null")
    of_depth = found.groupBy("row", "depth", "parent").agg(F.sum("chars").alias("chars"))
    least = of_depth.groupBy("row").agg(F.min("depth").alias("least"))
    votes = of_depth.join(least, "row").where(F.col("depth") == F.col("least"))
    best = votes.groupBy("row").agg(F.min(F.struct((-F.col("chars")).alias("less"), F.col("parent").alias("parent"))).alias("b"))
    links = stored(best.select("row", F.col("b.parent.row").alias("parent"), F.col("b.parent.conv").alias("parent_conv"), F.col("b.parent.turn").alias("parent_turn")))
    marked = messages.join(plain, "row", "left").join(quoting.withColumn("has_quotes", F.lit(True)), "row", "left")
    return marked.withColumn("own_text", F.coalesce("own_text", F.lit(""))).withColumn("has_quotes", F.coalesce("has_quotes", F.lit(False))), links


def _paths(links: DataFrame, messages: DataFrame) -> DataFrame:
    """row, root, path (places from below the root down) of every linked message, by pointer doubling."""
    place = messages.select("row", F.struct("conv", "turn", "row").alias("place"))
    state = stored(links.join(place, "row").select("row", F.col("parent").alias("up"), F.array("place").alias("path"), F.lit(False).alias("moved")))
    while True:
        above = state.select(F.col("row").alias("a_row"), F.col("up").alias("a_up"), F.col("path").alias("a_path"))
        joined = state.join(above, F.col("up") == F.col("a_row"), "left")
        moved = F.col("a_row").isNotNull()
        state = stored(joined.select("row", F.when(moved, F.col("a_up")).otherwise(F.col("up")).alias("up"), F.when(moved, F.concat("a_path", "path")).otherwise(F.col("path")).alias("path"), moved.alias("moved")))
        if state.where("moved").isEmpty():
            return state.select("row", F.col("up").alias("root"), "path")


def threads(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """thread, path, depth, conv, turn, role, text (without quotes), has_quotes, parent_conv, parent_turn of each message."""
    c = conversations
    messages = stored(c.select(c[conv_col].alias("conv"), c[turn_col].alias("turn"), c[role_col].alias("role"), F.coalesce(c[text_col], F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row")))
    marked, links = link(messages)
    paths = _paths(links, messages)
    roots = messages.select(F.col("row").alias("root"), F.struct("conv", "turn", "row").alias("root_place"))
    placed = paths.join(roots, "root").select("row", "root_place", F.col("path"))
    joined = marked.join(placed, "row", "left").join(links.drop("parent"), "row", "left")
    top = F.coalesce("root_place", F.struct("conv", "turn", "row"))
    path = F.concat(F.array(top), F.coalesce("path", F.array().cast("array<struct<conv:bigint,turn:bigint,row:bigint>>")))
    return joined.select(top["conv"].alias("thread"), path.alias("path"), (F.size(path) - 1).alias("depth"), "conv", "turn", "role", F.col("own_text").alias("text"), "has_quotes", "parent_conv", "parent_turn")
