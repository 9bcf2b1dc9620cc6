"""N-gram Jaccard self-join: near-duplicate groups of documents by their word shingles, exactly.

Method: the universe of shingles is hashed into segments, as many for each band of set sizes as two sets of that band
may differ in, and some more. A pair that is near enough differs in at most H shingles, so of any H + 1 segments of one set at
least one is the same in the other. Segments are looked up by the hash of their content. Which H + 1 segments of a set are
used is free: the cheapest ones are, those whose content the fewest sets have; by these it asks, and by these it is found. A set with H + 1 segments that no other has
costs nothing and leaves at once; empty segments are never used. Sets below SMALL shingles have a segment for each shingle.
The few sets whose shingles fall into too few segments are compared by an inverted index over single shingles.

Candidates are verified on the whole sets. In a large group of equal segments every set is first compared with one
pivot; the pairs that are still in different components are then compared by new pivots, and at last all with all,
so nothing is lost and a group of thousands of near copies makes about as many pairs as it has members.
Exact copies of a set are one entry from the start, told apart by a 64-bit digest.

Cases: null and empty texts have no shingles, and are linked with nothing; a text of fewer than five words has its
whole word sequence as one shingle. Whole texts count, however long. Ties at exactly the threshold are links. Repeated rows
are copies of each other and each keeps its row; a null id never becomes a component id unless a
component has no other. Empty tables give empty results. Columns other than the two named ones are not looked at.

Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from toolloom.llm.common import renamed, shuffle_partitions, stored
from toolloom.llm.graph import components
from toolloom.llm.words import Words, chunks, mix

SMALL = 64
BAND = 1.5
SLACK = 1.3
MORE = 12
BUCKET_SIGNATURES = 1_500_000
FEW = 6
BITMAP = 512
ROUNDS = 3


class Scheme:
    """Bands, segment counts and differences for the similarity near / of."""

    def __init__(self, near: int, of: int, slack: float = SLACK, more: int = MORE):
        self.near, self.of, self.slack, self.more = near, of, slack, more

    def bands(self, n: int) -> list[int]:
        """The bands in which a set of n shingles takes part: its own, and the next one if a larger set there can be near."""
        k = 0 if n < SMALL else 1 + int(math.log(n / SMALL) / math.log(BAND) + 1e-9)
        k = k + 1 if n >= self.begin(k + 1) else k - 1 if n < self.begin(k) else k
        return [k, k + 1] if n * self.of >= self.begin(k + 1) * self.near else [k]

    @staticmethod
    def begin(k: int) -> int:
        return 0 if k == 0 else math.ceil(SMALL * BAND ** (k - 1))

    def segments(self, k: int) -> int:
        """0: a segment for each shingle."""
        return 0 if k == 0 else math.ceil(self.slack * self.differ(self.begin(k + 1) - 1)) + self.more

    def differ(self, n: int) -> int:
        """Shingles in which a set of n and one that is not larger may differ."""
        return 2 * n * (self.of - self.near) // (self.of + self.near)

    def differ_at_most(self, n: int) -> int:
        """The same for a partner of any size."""
        return (n + n * self.of // self.near) * (self.of - self.near) // (self.of + self.near)

    def fits(self, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        return np.minimum(n, m) * self.of >= np.maximum(n, m) * self.near

    def signatures(self, shingles: np.ndarray, k: int) -> np.ndarray:
        """One hash for each segment that is not empty."""
        own = np.uint64((0x9E3779B97F4A7C15 * (k + 1)) & (2**64 - 1))
        m = self.segments(k)
        if not m:
            return mix(shingles + own)
        x = mix(shingles + own)
        at = ((x >> np.uint64(32)) % np.uint64(m)).astype(np.int64)
        sums = np.zeros(m, np.uint64)
        np.add.at(sums, at, mix(x))
        used = np.flatnonzero(np.bincount(at, minlength=m))
        return mix(sums[used] + mix(used.astype(np.uint64) + own))


def digest(shingles: np.ndarray) -> int:
    return int(mix(mix(shingles).sum(keepdims=True) + np.uint64(len(shingles))).view(np.int64)[0])


def _pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x).tobytes()


def _sizes(docs: DataFrame) -> DataFrame:
    """doc_id, n, digest of each row."""

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            sets = Words(part.column("text")).shingle_sets()
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), pa.array([digest(s) for s in sets], pa.int64())], ["doc_id", "n", "digest"])

    return docs.mapInArrow(sizes, "doc_id long, n long, digest long")


_SIGNED = pa.schema([("bucket", pa.int32()), ("owners", pa.binary()), ("bands", pa.binary()), ("counts", pa.binary()), ("signatures", pa.binary()), ("facts", pa.binary())])
_FACT = np.dtype([("digest", "<i8"), ("band", "<i4"), ("n", "<i4"), ("used", "<i4")])


def _signed(docs: DataFrame, scheme: Scheme, buckets: int) -> DataFrame:
    """For each chunk of texts and each bucket of signatures the sets (owner, band) and their signatures, packed.

    A set that the task has seen before is left out. facts: of the sets whose digest belongs to the bucket.
    """

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for part in chunks(batches, 4_000_000):
            facts, found = [], []
            for s in (s for small in chunks(iter([part])) for s in Words(small.column("text")).shingle_sets()):
                if scheme.differ_at_most(len(s)) == 0 or (d := digest(s)) in seen:
                    continue
                seen.add(d)
                for k in scheme.bands(len(s)):
                    x = scheme.signatures(s, k)
                    facts.append((d, k, len(s), len(x)))
                    found.append(x)
            if not facts:
                continue
            facts = np.array(facts, _FACT)
            x = np.concatenate(found)
            unit = np.repeat(np.arange(len(facts)), facts["used"])
            bucket = (x % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            x, unit, bucket = (x >> np.uint64(32)).astype(np.uint32)[order], unit[order], bucket[order]
            home = facts["digest"] % buckets
            bounds = np.searchsorted(bucket, np.arange(buckets + 1))
            columns = [[] for _ in _SIGNED]
            for b in np.union1d(np.unique(bucket), np.unique(home)).tolist():
                u, n = np.unique(unit[bounds[b] : bounds[b + 1]], return_counts=True)
                row = (b, _pack(facts["digest"][u]), _pack(facts["band"][u].astype(np.uint8)), _pack(n.astype(np.uint16 if n.size and n.max() < 65536 else np.uint32)), _pack(x[bounds[b] : bounds[b + 1]]), _pack(facts[home == b]))
                for c, v in zip(columns, row):
                    c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SIGNED)], schema=_SIGNED)

    return docs.mapInArrow(sign, "bucket int, owners binary, bands binary, counts binary, signatures binary, facts binary")


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where runs of equal keys begin, and the end; the keys are sorted."""
    n = len(keys[0])
    change = np.zeros(n, bool)
    if n:
        change[0] = True
    for k in keys:
        change[1:] |= k[1:] != k[:-1]
    return np.append(np.flatnonzero(change), n)


_PLACE = [("bucket", pa.int32()), ("group", pa.int32())]
_SHARED = pa.schema(_PLACE + [(n, pa.binary()) for n in ("digests", "bands", "counts", "signatures", "commons", "facts")])
_SHARED_SQL = "bucket int, group int, digests binary, bands binary, counts binary, signatures binary, commons binary, facts binary"


def _shared(groups: int):
    """Of one bucket: the signatures that several sets have, with their number of sets, for each (set, band); packed by group of digests."""

    def shared(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        facts = np.unique(np.concatenate([np.frombuffer(x.as_py(), _FACT) for x in table.column("facts")]))
        owners, bands, signatures = [], [], []
        for o, b, c, s in zip(*(table.column(n).to_pylist() for n in ("owners", "bands", "counts", "signatures"))):
            o, s = np.frombuffer(o, np.int64), np.frombuffer(s, np.uint32)
            c = np.frombuffer(c, np.uint16 if len(c) == 2 * len(o) else np.uint32)
            owners.append(np.repeat(o, c)), bands.append(np.repeat(np.frombuffer(b, np.uint8), c)), signatures.append(s)
        owner, band, sig = np.concatenate(owners), np.concatenate(bands), np.concatenate(signatures)
        order = np.lexsort((owner, band, sig))
        owner, band, sig = owner[order], band[order], sig[order]
        once = _runs(sig, band, owner)[:-1]  # the same set comes from several tasks
        owner, band, sig = owner[once], band[once], sig[once]
        bounds = _runs(sig, band)
        common = np.repeat(np.diff(bounds), np.diff(bounds))
        some = common > 1
        owner, band, sig, common = owner[some], band[some], sig[some], common[some].astype(np.uint32)
        order = np.lexsort((sig, band, owner, owner % groups))
        owner, band, sig, common = owner[order], band[order], sig[order], common[order]
        at = _runs(owner, band)
        unit, n = at[:-1], np.diff(at)
        home, fact_home = owner[unit] % groups, facts["digest"] % groups
        facts = facts[np.argsort(fact_home, kind="stable")]
        homes = (home, owner % groups, np.sort(fact_home))
        used = np.union1d(home, fact_home).astype(np.int64)  # groups with something to hear, of however many
        edges = [(np.searchsorted(h, used, "left"), np.searchsorted(h, used, "right")) for h in homes]
        out = []
        for i, g in enumerate(used.tolist()):
            u, x, p = (slice(left[i], right[i]) for left, right in edges)
            out.append((bucket, g, *map(_pack, (owner[unit[u]], band[unit[u]], n[u].astype(np.uint32), sig[x], common[x], facts[p]))))
        if not out:
            return _SHARED.empty_table()
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SHARED)], schema=_SHARED)

    return shared


_CHOSEN = pa.schema(_PLACE + [(n, pa.binary()) for n in ("digests", "bands", "sizes", "counts", "signatures", "asks")])
_CHOSEN_SQL = "bucket int, group int, digests binary, bands binary, sizes binary, counts binary, signatures binary, asks binary"


def _choose(scheme: Scheme):
    """Allocation, of one group of digests: by which of its segments each set asks and is found.

    Segments in the order of how many sets have them, then by hash, are in the same order for any two sets; so the first
    one that two near sets share is among the first H + 1 of both. A set asks by those, H for partners that are not larger,
    and is found by those, H for partners of any size. own: segments that no other set has come first and cost nothing. Row -1: the digests
    that are still open, and whether they have too few segments.
    """

    def choose(table: pa.Table) -> pa.Table:
        group = table.column("group")[0].as_py()
        facts = np.sort(np.concatenate([np.frombuffer(x.as_py(), _FACT) for x in table.column("facts")]), order=["digest", "band"])
        owners, bands, buckets, sigs, commons = [], [], [], [], []
        for k, d, b, c, s, m in zip(*(table.column(n).to_pylist() for n in ("bucket", "digests", "bands", "counts", "signatures", "commons"))):
            c = np.frombuffer(c, np.uint32)
            owners.append(np.repeat(np.frombuffer(d, np.int64), c)), bands.append(np.repeat(np.frombuffer(b, np.uint8), c))
            sigs.append(np.frombuffer(s, np.uint32)), commons.append(np.frombuffer(m, np.uint32)), buckets.append(np.full(int(c.sum()), k, np.int32))
        owner, band, bucket, sig, common = (np.concatenate(x) for x in (owners, bands, buckets, sigs, commons))
        order = np.lexsort((bucket, sig, common, band, owner))
        owner, band, bucket, sig, common = owner[order], band[order], bucket[order], sig[order], common[order]
        bounds = _runs(owner, band)
        firsts, shared_by = bounds[:-1], np.diff(bounds)
        keys = facts[["digest", "band"]].copy()
        mine = np.empty(len(firsts), keys.dtype)
        mine["digest"], mine["band"] = owner[firsts], band[firsts]
        place = np.searchsorted(keys, mine)
        n, used = facts["n"].astype(np.int64), facts["used"].astype(np.int64)
        shared = np.zeros(len(facts), np.int64)
        shared[place] = shared_by
        own = used - shared
        larger = n >= np.array([scheme.begin(int(k)) for k in range(int(facts["band"].max()) + 1)])[facts["band"]]
        differ = np.array([scheme.differ(int(x)) for x in n])
        differ_at_most = np.array([scheme.differ_at_most(int(x)) for x in n])
        odd = larger & (used <= differ)
        asks = np.where(larger & ~odd, np.maximum(differ + 1 - own, 0), 0)
        found = np.maximum(differ_at_most + 1 - own, 0)
        is_open = odd | (found > 0)
        rank = np.arange(len(owner)) - np.repeat(firsts, shared_by)
        keep = rank < np.repeat(found[place], shared_by)
        ask = (rank < np.repeat(asks[place], shared_by))[keep].astype(np.uint8)
        size = np.repeat(n[place], shared_by)[keep].astype(np.uint32)
        owner, band, bucket, sig = owner[keep], band[keep], bucket[keep], sig[keep]
        order = np.argsort(bucket, kind="stable")
        owner, band, bucket, sig, ask, size = (x[order] for x in (owner, band, bucket, sig, ask, size))
        out = []
        edges = _runs(bucket)
        for x, y in zip(edges, edges[1:]):
            units = _runs(owner[x:y], band[x:y])
            first = units[:-1] + x
            counts = np.diff(units).astype(np.uint32)
            out.append((int(bucket[x]), group, *map(_pack, (owner[first], band[first], size[first], counts, sig[x:y], ask[x:y]))))
        if is_open.any():
            names, which = np.unique(facts["digest"][is_open], return_inverse=True)
            flags = np.zeros(len(names), np.uint8)
            np.maximum.at(flags, which, odd[is_open].astype(np.uint8))
            out.append((-1, group, _pack(names), None, None, None, None, _pack(flags)))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(_CHOSEN), _CHOSEN)], schema=_CHOSEN)

    return choose


def _open_digests(chosen: DataFrame) -> DataFrame:
    """digest, odd of the sets that may have a partner."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, o in zip(batch.column("digests").to_pylist(), batch.column("asks").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(d, np.int64)), pa.array(np.frombuffer(o, np.uint8) > 0)], ["digest", "odd"])

    return chosen.where("bucket = -1").select("digests", "asks").mapInArrow(unpack, "digest long, odd boolean")


_LABELLED = pa.schema([*_CHOSEN, pa.field("labels", pa.binary()), pa.field("bitmaps", pa.binary())])
_LABELLED_SQL = _CHOSEN_SQL + ", labels binary, bitmaps binary"


def _relabel(chosen: pa.Table, known: pa.Table) -> pa.Table:
    """Of one group: label and bitmap of each digest next to it. known: node, label, bitmap."""
    node, label = known.column("node").to_numpy(), known.column("label").to_numpy()
    order = np.argsort(node)
    node, label = node[order], label[order]
    bitmaps = np.frombuffer(b"".join(known.column("bitmap").to_pylist()), np.uint64).reshape(len(order), -1)[order]
    places = [np.searchsorted(node, np.frombuffer(d, np.int64)) for d in chosen.column("digests").to_pylist()]
    columns = [pa.array([_pack(x[at]) for at in places], pa.binary()) for x in (label, bitmaps)]
    return pa.Table.from_arrays([*(chosen.column(f.name) for f in _CHOSEN), *columns], schema=_LABELLED)


def _bitmaps(sets: DataFrame) -> DataFrame:
    """digest, bitmap: each shingle flips one of BITMAP bits. Two bitmaps never differ in more bits than the sets in shingles."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shingles = (np.frombuffer(x.as_py(), np.uint64) % np.uint64(BITMAP) for x in batch.column("shingles"))
            bits = [_pack(np.packbits(np.bincount(x.astype(np.int64), minlength=BITMAP) % 2 == 1)) for x in shingles]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), pa.array(bits, pa.binary())], ["digest", "bitmap"])

    return sets.mapInArrow(fold, "digest long, bitmap binary")


_PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


class _Entries:
    """The entries of one bucket by segment: rows bound[i] to bound[i + 1] have one segment. unit: the set of each entry."""

    def __init__(self, table: pa.Table, turn: int):
        read = lambda c, t: [np.frombuffer(x.as_py(), t) for x in table.column(c)]
        names = (("digests", np.int64), ("bands", np.uint8), ("sizes", np.uint32), ("counts", np.uint32))
        self.digest, self.band, n, counts = (np.concatenate(read(c, t)) for c, t in names)
        self.n = n.astype(np.int64)
        labelled = "labels" in table.column_names
        self.label = np.concatenate(read("labels", np.int64)) if labelled else self.digest
        self.bitmap = np.concatenate([x.reshape(-1, BITMAP // 64) for x in read("bitmaps", np.uint64)]) if labelled else None
        sig, ask = np.concatenate(read("signatures", np.uint32)), np.concatenate(read("asks", np.uint8))
        unit = np.repeat(np.arange(len(counts)), counts)
        rank = mix(self.digest.view(np.uint64) + np.uint64(977 * (turn + 2)))
        order = np.lexsort((rank[unit], self.band[unit], sig))
        self.unit, self.ask, self.sig = unit[order], ask[order].astype(bool), sig[order]
        self.bound = _runs(self.sig, self.band[self.unit])


def _crowded(buckets: int):
    """Of one bucket: the entries of segments that more than FEW sets of more than one component have; the others are settled."""

    def crowded(table: pa.Table) -> pa.Table:
        e = _Entries(table, 0)
        bucket = table.column("bucket")[0].as_py()
        keep = np.zeros(len(e.unit), bool)
        for a, b in zip(e.bound, e.bound[1:]):
            keep[a:b] = b - a > FEW and e.ask[a:b].any() and (e.label[e.unit[a:b]] != e.label[e.unit[a]]).any()
        unit, sig, ask = e.unit[keep], e.sig[keep], e.ask[keep]
        home = e.digest[unit] % buckets
        order = np.lexsort((sig, unit, home))
        unit, sig, ask, home = unit[order], sig[order], ask[order], home[order]
        out = []
        edges = _runs(home)
        for x, y in zip(edges, edges[1:]):
            at = _runs(unit[x:y])
            u = unit[x:y][at[:-1]]
            sizes, counts = e.n[u].astype(np.uint32), np.diff(at).astype(np.uint32)
            out.append((bucket, int(home[x]), *map(_pack, (e.digest[u], e.band[u], sizes, counts, sig[x:y], ask[x:y].astype(np.uint8)))))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(_CHOSEN), _CHOSEN)], schema=_CHOSEN)

    return crowded


def _pairs(scheme: Scheme, turn: int):
    """Of one bucket: candidate pairs. Turn 0: all of segments of up to FEW sets, of others each set with the first one.

    Later turns: each set with one of the largest component there. Turn -1: all that are still in different components and
    whose bitmaps don't differ too much.
    """

    def pairs(table: pa.Table) -> pa.Table:
        e = _Entries(table, turn)
        left, right = [], []
        for a, b in zip(e.bound, e.bound[1:]):
            unit, ask = e.unit[a:b], e.ask[a:b]
            if b - a < 2 or not ask.any():
                continue
            n, own = e.n[unit], e.digest[unit]
            names, which, sizes = np.unique(e.label[unit], return_inverse=True, return_counts=True)
            if len(names) == 1:
                continue
            if len(unit) <= FEW or turn < 0:
                for i in range(len(unit) - 1):  # with those behind it, where one of the two asks
                    j = np.flatnonzero((which[i + 1 :] != which[i]) & (ask[i + 1 :] | ask[i]) & scheme.fits(n[i + 1 :], n[i])) + i + 1
                    if turn < 0 and len(j):
                        apart = np.bitwise_count(e.bitmap[unit[j]] ^ e.bitmap[unit[i]]).sum(axis=1, dtype=np.int64)
                        j = j[apart <= (n[j] + n[i]) * (scheme.of - scheme.near) // (scheme.of + scheme.near)]
                    left.append(np.full(len(j), own[i])), right.append(own[j])
            else:
                large = int(np.argmax(sizes))
                i = int(np.flatnonzero(which == large)[0])
                j = np.flatnonzero(which != large)
                j = j[scheme.fits(n[j], n[i])]
                left.append(np.full(len(j), own[i])), right.append(own[j])
        if not left:
            return _PAIR.empty_table()
        x, y = np.concatenate(left), np.concatenate(right)
        both = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)], 1), axis=0)
        return pa.Table.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], schema=_PAIR)

    return pairs


def _sets(docs: DataFrame, wanted: DataFrame, sizes: DataFrame) -> DataFrame:
    """digest, shingles (packed) of the wanted digests; each from one document that has it."""
    one = sizes.join(wanted, "digest", "left_semi").groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id")).alias("d")).select(F.col("digest").alias("wanted"), F.col("d.doc_id").alias("id"))

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            found = [digest(s) for s in Words(part.column("text")).shingle_sets()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), pa.array(found, pa.int64())], ["doc_id", "text", "digest"])

    # by both: rows with null or repeated ids do not multiply
    texts = docs.mapInArrow(digests, "doc_id long, text string, digest long").join(one, (F.col("digest") == F.col("wanted")) & F.col("doc_id").eqNullSafe(F.col("id"))).select("text", "wanted")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches):
            yield pa.RecordBatch.from_arrays([part.column("wanted"), pa.array([_pack(s) for s in Words(part.column("text")).shingle_sets()], pa.binary())], ["digest", "shingles"])

    return texts.mapInArrow(sets, "digest long, shingles binary").dropDuplicates(["digest"])


def _verified(pairs: DataFrame, sets: DataFrame, near: int, of: int) -> DataFrame:
    """The pairs (a, b) that are near enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = np.sort(np.concatenate([x, y]))
                same = int((both[1:] == both[:-1]).sum())
                keep.append(of * same >= near * (len(x) + len(y) - same))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_b = pairs.join(sets.select(F.col("digest").alias("b"), F.col("shingles").alias("y")), "b")
    with_a = with_b.join(sets.select(F.col("digest").alias("a"), F.col("shingles").alias("x")), "a")
    return with_a.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long")


def _by_shingle(docs: DataFrame, odd: DataFrame, near: int, of: int) -> DataFrame:
    """All links (a, b) of the odd digests (digest, shingles), by an index over their single shingles."""

    def rows(column: str, text: bool):
        def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in chunks(batches) if text else batches:
                sets = Words(part.column("text")).shingle_sets() if text else [np.frombuffer(x.as_py(), np.uint64) for x in part.column("shingles")]
                sets = [s for s in sets if len(s)]
                sizes = [len(s) for s in sets]
                flat = np.concatenate(sets).view(np.int64) if sets else np.zeros(0, np.int64)
                keys = [np.repeat(x, sizes).astype(np.int64) for x in ([digest(s) for s in sets], sizes)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (*keys, flat)], [column, f"n_{column}", "shingle"])

        return explode

    ours = odd.select("shingles").mapInArrow(rows("a", False), "a long, n_a long, shingle long")
    theirs = docs.select("text").mapInArrow(rows("b", True), "b long, n_b long, shingle long").dropDuplicates(["b", "shingle"])
    same = ours.join(theirs, "shingle").where("a <> b").groupBy("a", "b", "n_a", "n_b").agg(F.count(F.lit(1)).alias("same"))
    return same.where(f"{of} * same >= {near} * (n_a + n_b - same)").select("a", "b")


def near_groups(docs: DataFrame, near: int = 80, of: int = 100, id_col: str = "doc_id", text_col: str = "text", scheme: Scheme | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id of every row; documents link when of * intersection >= near * union."""
    scheme = scheme or Scheme(near, of)
    docs = renamed(docs, doc_id=id_col, text=text_col)
    sizes = stored(_sizes(docs))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first().n
    buckets = max(shuffle_partitions(docs.sparkSession), math.ceil(0.6 * total / BUCKET_SIGNATURES))
    shared = stored(_signed(docs, scheme, buckets).groupBy("bucket").applyInArrow(_shared(buckets), _SHARED_SQL))
    chosen = stored(shared.groupBy("group").applyInArrow(_choose(scheme), _CHOSEN_SQL))
    open_ = stored(_open_digests(chosen))
    chosen = chosen.where("bucket >= 0")
    sets = stored(_sets(docs, open_.select("digest"), sizes.select("doc_id", "digest")))

    links = None
    odd = open_.where("odd").select("digest").distinct()
    if not odd.isEmpty():
        links = stored(_by_shingle(docs, sets.join(odd, "digest", "left_semi"), near, of))
    labels = components(links) if links is not None else None
    bitmaps = None
    for turn in [*range(ROUNDS), -1]:
        entries = chosen
        if turn != 0:  # what is left after the first turn
            if bitmaps is None:
                bitmaps = stored(_bitmaps(sets))
            known = bitmaps.withColumnRenamed("digest", "node").withColumn("label", F.col("node"))
            if labels is not None:
                known = bitmaps.join(labels, F.col("digest") == F.col("node"), "left").select(F.col("digest").alias("node"), F.coalesce("label", "digest").alias("label"), "bitmap")
            by_group = known.select("node", "label", "bitmap", F.pmod("node", F.lit(buckets)).cast("int").alias("group")).groupBy("group")
            labelled = chosen.groupBy("group").cogroup(by_group).applyInArrow(_relabel, _LABELLED_SQL)
            entries = labelled
            if turn == 1:
                chosen = stored(labelled.groupBy("bucket").applyInArrow(_crowded(buckets), _CHOSEN_SQL))
                entries = chosen.groupBy("group").cogroup(by_group).applyInArrow(_relabel, _LABELLED_SQL)
        pairs = stored(entries.groupBy("bucket").applyInArrow(_pairs(scheme, turn), "a long, b long").distinct())
        if pairs.isEmpty():
            if turn <= 0:
                break
            continue
        found = _verified(pairs, sets, near, of)
        links = stored(found if links is None else links.unionByName(found))
        labels = components(links)
    classes = sizes.where("n > 0").groupBy("digest", "n").agg(F.min("doc_id").alias("first"))
    if labels is not None:
        named = classes.join(labels.withColumnRenamed("node", "digest"), "digest", "left").withColumn("label", F.coalesce("label", "digest"))
        least = named.groupBy("label").agg(F.min("first").alias("component_id"))
        classes = named.join(least, "label").select("digest", "n", "component_id")
    else:
        classes = classes.withColumnRenamed("first", "component_id")
    joined = sizes.join(classes.withColumnRenamed("n", "m"), (sizes["digest"] == classes["digest"]) & (F.col("n") == F.col("m")) & (F.col("n") > 0), "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
