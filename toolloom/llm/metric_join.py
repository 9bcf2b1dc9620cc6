"""Near-duplicate vectors by an exact metric range join: pivots, replication by the triangle inequality, cells on their own.

Vectors are compared inside their label, as unit vectors, so cosine >= c is a distance of at most r = sqrt(2 - 2c). Labels
of more than CELL different vectors get pivots, about one for each CELL vectors, taken by a hash. A vector's home is the
cell of its nearest pivot i. It may have a neighbour y in the cell of pivot j only if

    d(x, j) <= r + radius(j)                      (d(x, j) <= d(x, y) + d(y, j))
    d(x, j)^2 - d(x, i)^2 <= 2 r d(i, j)          (d(y, j) <= d(y, i); with d(i, j) <= d(x, i) + d(x, j): d(x, j) - d(x, i) <= 2 r)

and is sent there as a guest. So a cell has all neighbours of its homes and needs no other cell. Cells are compared in blocks of
BLOCK homes and BLOCK members: a dense cell becomes many tasks, none of which holds it whole. A block returns each home's
number of neighbours and, for connected components, one edge a vector to its least block mate reached, never the pairs.

Equal vectors are one vector with a count. On data without any clusters, distances say little and cells get many guests:
the compared pairs then come near those of blocks without pivots; no link is lost either way.

Vectors that are null, empty, zero, or hold null or non-finite components, and rows without label or id, link with nothing: n_links 0
and a component of their own. Vectors of different lengths don't link. Ties between pivots go to the first by
hash. Rows that repeat an id and vector link with each other; an id with different vectors stands for different vectors.
An empty table gives an empty one. Vectors have one length a label as a rule, so there are no very long ones; no column but the named is looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from toolloom.llm.common import join_hot, stored
from toolloom.llm.graph import spread_components

CELL = 2048
BLOCK = 8192
DEALT = 20_000
_ROWS = 512
_CLOSE = 1e-9
_NODE = ["rep", "h1", "h2"]


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: only finite components, not all of them zero."""
    wide = vector.cast("array<double>")
    strange = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~strange & F.exists(wide, lambda x: x != 0), F.lit(False))


def unit(vectors: pa.Array) -> np.ndarray:
    """Arrow lists of equal length as unit vectors in double precision."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    wide = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    wide = wide / np.abs(wide).max(axis=1, keepdims=True)  # squares of very large or small components stay finite
    return wide / np.sqrt((wide * wide).sum(axis=1, keepdims=True))


def _dealt(rows: DataFrame, pivots: DataFrame):
    """Rows (with n of their label) and all pivots of their label, in parts of about DEALT rows."""
    parts = F.ceil(F.col("n_label") / DEALT).cast("int")
    left = rows.withColumn("_part", F.pmod(F.col("h1"), parts).cast("int"))
    copies = pivots.withColumn("_part", F.explode(F.sequence(F.lit(0), parts - 1)))
    keys = ["label", "dim", "_part"]
    return left.groupBy(*keys).cogroup(copies.select(*[F.col(c).alias(f"p_{c}") for c in copies.columns]).groupBy(*[f"p_{k}" for k in keys]))


def _sorted(pivots: pa.Table) -> pa.Table:
    return pivots.sort_by([("p_h1", "ascending"), ("p_h2", "ascending")])


def homes(rows: DataFrame, pivots: DataFrame) -> DataFrame:
    """rows with c1, c2 (their nearest pivot's hashes) and far, the distance to it."""
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)

    def nearest(rows: pa.Table, pivots: pa.Table) -> pa.Table:
        pivots = _sorted(pivots)
        if not rows.num_rows:
            return rows.drop_columns("_part").append_column("c1", pa.array([], pa.int64())).append_column("c2", pa.array([], pa.int64())).append_column("far", pa.array([], pa.float64()))
        x, p = unit(rows.column("vec")), unit(pivots.column("p_vec"))
        best, top = [], []
        for a in range(0, len(x), _ROWS):
            cosine = x[a : a + _ROWS] @ p.T
            best.append(cosine.argmax(axis=1))
            top.append(cosine.max(axis=1))
        best, far = np.concatenate(best), np.sqrt(np.maximum(0, 2 - 2 * np.concatenate(top)))
        found = rows.drop_columns("_part")
        for name in ("h1", "h2"):
            found = found.append_column(f"c{name[1]}", pivots.column(f"p_{name}").take(pa.array(best)))
        return found.append_column("far", pa.array(far))

    return _dealt(rows, pivots).applyInArrow(nearest, f"{kinds}, c1 long, c2 long, far double")


def guests(rows: DataFrame, pivots: DataFrame, cosine: float) -> DataFrame:
    """rows (with c1, c2) once for each other cell that may hold a neighbour. pivots have their cell's radius."""
    kept = [c for c in rows.columns if c not in ("c1", "c2")]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name in kept)
    reach = float(np.sqrt(2 - 2 * cosine))

    def visit(rows: pa.Table, pivots: pa.Table) -> pa.Table:
        pivots = _sorted(pivots)
        codes = [pivots.column(f"p_{h}").combine_chunks() for h in ("h1", "h2")]
        p, radius = unit(pivots.column("p_vec")), pivots.column("p_radius").to_numpy()
        place = {code: i for i, code in enumerate(zip(*[c.to_pylist() for c in codes]))}
        own = np.array([place[c] for c in zip(rows.column("c1").to_pylist(), rows.column("c2").to_pylist())], np.int64)
        sent, bounds = [], [0]
        for a in range(0, rows.num_rows, _ROWS):
            home = own[a : a + _ROWS]
            near = unit(rows.column("vec").slice(a, _ROWS)) @ p.T
            far = np.sqrt(np.maximum(0, 2 - 2 * near))
            between = np.sqrt(np.maximum(0, 2 - 2 * (p[home] @ p.T)))
            lead = near[np.arange(len(home)), home][:, None] - near  # half the difference of the squared distances
            may = (far <= reach + radius + _CLOSE) & (lead <= reach * between + _CLOSE)
            may[np.arange(len(home)), home] = False
            sent.append(np.nonzero(may)[1])
            bounds += (bounds[-1] + np.cumsum(may.sum(axis=1))).tolist()
        cells, found = np.concatenate([*sent, np.zeros(0, np.int64)]), rows.select(kept)
        for k in (0, 1):
            found = found.append_column(f"c{k + 1}", pa.LargeListArray.from_arrays(bounds, codes[k].take(pa.array(cells))).cast(pa.list_(pa.int64())))
        return found

    visits = _dealt(rows, pivots).applyInArrow(visit, f"{kinds}, c1 array<long>, c2 array<long>")
    return visits.withColumn("_to", F.explode(F.arrays_zip("c1", "c2"))).select(*kept, F.col("_to.c1").alias("c1"), F.col("_to.c2").alias("c2"))


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of a[k] and b[k] for all k; label holds each one's least member known, at last its set's least."""
    while True:
        while True:  # every label's label, until they are roots
            further = label[label]
            if (further == label).all():
                break
            label[:] = further
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))


def compare(rows: pa.Table, cosine: float) -> pa.Table:
    """One block: number of links of each home in it (of guests 0), and the least vector reached inside the block."""
    rows = rows.sort_by([(c, "ascending") for c in _NODE])
    x, copies = unit(rows.column("vec")), rows.column("copies").to_numpy()
    left = np.flatnonzero(rows.column("is_left").to_numpy(zero_copy_only=False))
    right = np.flatnonzero(rows.column("is_right").to_numpy(zero_copy_only=False))
    label, links = np.arange(len(x)), np.zeros(len(x), np.int64)
    for a in range(0, len(left), _ROWS):
        some = left[a : a + _ROWS]
        found = x[some] @ x[right].T
        near = found >= cosine
        close_row, close_column = np.nonzero(np.abs(found - cosine) < _CLOSE)  # where the order of summing could matter
        if len(close_row):
            exact = (x[some[close_row]] * x[right[close_column]]).sum(axis=1)
            near[close_row, close_column] = exact >= cosine
        near &= some[:, None] != right[None, :]
        links[some] = near @ copies[right]
        i, j = np.nonzero(near)
        _merge(label, some[i], right[j])
    shown = np.zeros(len(x), bool)
    shown[left] = True
    at = np.flatnonzero(shown | (label != np.arange(len(x))))
    table = rows.select(_NODE).take(pa.array(at))
    roots = rows.select(_NODE).take(pa.array(label[at]))
    for c in _NODE:
        table = table.append_column(f"root_{c}", roots.column(c))
    return table.append_column("links", pa.array(links[at]))


def _blocks(members: DataFrame) -> DataFrame:
    """members (home, c1, c2) once for each block of their cell that they are in, as a home (left), a member (right) or both."""
    sizes = members.groupBy("c1", "c2").agg(F.count_if("home").alias("n_homes"), F.count(F.lit(1)).alias("n_members"))
    sides = sizes.select("c1", "c2", F.ceil(F.col("n_homes") / BLOCK).cast("int").alias("rows"), F.ceil(F.col("n_members") / BLOCK).cast("int").alias("columns"))
    dealt = join_hot(members, stored(sides.where("rows > 0")), ["c1", "c2"])
    own = dealt.withColumn("_i", F.pmod(F.xxhash64("h1"), F.col("rows")).cast("int")).withColumn("_j", F.pmod(F.xxhash64("h2"), F.col("columns")).cast("int"))
    across = F.transform(F.sequence(F.lit(0), F.col("columns") - 1), lambda j: F.struct(F.col("_i").alias("i"), j.alias("j")))
    down = F.transform(F.sequence(F.lit(0), F.col("rows") - 1), lambda i: F.struct(i.alias("i"), F.col("_j").alias("j")))
    places = F.when(F.col("home"), F.array_union(across, down)).otherwise(down)
    placed = own.withColumn("_at", F.explode(places))
    is_left = F.col("home") & (F.col("_at.i") == F.col("_i"))
    return placed.select("c1", "c2", F.col("_at.i").alias("i"), F.col("_at.j").alias("j"), *_NODE, "copies", "vec", is_left.alias("is_left"), (F.col("_at.j") == F.col("_j")).alias("is_right"))


def near_vectors(table: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, n_links, component (least id reachable by links, the own one included), one row for each row."""
    named = table.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vec"))
    fit = F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("vec"))
    key = ["label", F.size("vec"), "vec"]
    rows = named.withColumn("fit", fit).withColumns({"h1": F.xxhash64(*key), "h2": F.xxhash64(F.lit(77), *key)})
    alike = rows.where("fit").groupBy("h1", "h2")
    first = [F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("label").alias("label"), F.first("vec").alias("vec")]
    vectors = stored(alike.agg(*first).withColumn("dim", F.size("vec")))
    sizes = stored(vectors.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n_label")))
    sized = stored(join_hot(vectors, sizes, ["label", "dim"]))
    # one pivot for CELL vectors, by a hash of its own
    chance = F.pmod(F.xxhash64("h2", "h1"), F.lit(1 << 40)) / float(1 << 40)
    pivots = stored(sized.where(f"n_label > {CELL}").where(chance * F.col("n_label") < F.ceil(F.col("n_label") / CELL)))
    split = pivots.select("label", "dim").distinct().withColumn("_split", F.lit(True))
    known = join_hot(sized, stored(split), ["label", "dim"], "left").withColumn("_split", F.coalesce("_split", F.lit(False)))
    known = stored(known)
    alone = known.where("not _split").drop("_split").withColumns({"c1": F.xxhash64("label", "dim"), "c2": F.xxhash64(F.lit(78), "label", "dim")})
    placed = stored(homes(known.where("_split").drop("_split"), pivots))
    radii = placed.groupBy("c1", "c2").agg(F.max("far").alias("radius"))
    wide = pivots.join(radii.withColumnsRenamed({"c1": "h1", "c2": "h2"}), ["h1", "h2"])
    sent = guests(placed.drop("far"), wide, cosine)
    columns = [*_NODE, "copies", "vec", "c1", "c2"]
    members = placed.select(*columns, F.lit(True).alias("home"))
    members = members.unionByName(sent.select(*columns, F.lit(False).alias("home"))).unionByName(alone.select(*columns, F.lit(True).alias("home")))
    blocks = _blocks(stored(members))
    id_type = named.schema["id"].dataType.simpleString()
    node = f"rep {id_type}, h1 long, h2 long"
    found = stored(blocks.groupBy("c1", "c2", "i", "j").applyInArrow(lambda t: compare(t, cosine), f"{node}, root_{node.replace(', ', ', root_')}, links long"))
    links = found.groupBy("h1", "h2").agg(F.sum("links").alias("links"))
    edges = found.select(F.struct(*_NODE).alias("a"), F.struct(*[F.col(f"root_{c}").alias(c) for c in _NODE]).alias("b")).where("a <> b").distinct()
    reached = spread_components(edges).select(F.col("node.h1").alias("h1"), F.col("node.h2").alias("h2"), F.col("label.rep").alias("component"))
    answer = stored(vectors.select("h1", "h2", "copies", "rep").join(links, ["h1", "h2"]).join(reached, ["h1", "h2"], "left"))
    answered = join_hot(stored(rows.where("fit").select("id", "h1", "h2")), answer, ["h1", "h2"])
    linked = answered.select("id", (F.col("links") + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component"))
    return linked.unionByName(rows.where("not fit").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")))
