"""SQL for DuckDB that gives the same rows as those registered queries of this subpackage that SQL can express."""

from __future__ import annotations


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return f"sha256({' || '.join(_field(f) for f in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _levels(name: str, leaves: str) -> str:
    """All nodes above leaves (tree, rank, digest, n), n being the number of nodes of the level."""
    return f"""{name}(tree, h, rank, digest, n) AS (
  SELECT tree, 0, rank, digest, n FROM {leaves}
  UNION ALL
  SELECT tree, h + 1, rank // 3, sha256(string_agg(digest, '' ORDER BY rank)), (any_value(n) + 2) // 3
  FROM {name} WHERE n > 1 GROUP BY tree, h, rank // 3
)"""


def _segments(name: str, nodes: str) -> str:
    """What stands to the left and right of each node in its run of three."""
    return f"""{name} AS (
  SELECT tree, h, rank,
    coalesce(string_agg(digest, '') OVER (PARTITION BY tree, h, rank // 3 ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
    coalesce(string_agg(digest, '') OVER (PARTITION BY tree, h, rank // 3 ORDER BY rank ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {nodes} WHERE n > 1
)"""


_CRC = """list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT)),
  lambda x, b: list_reduce(list_prepend(xor(x, b), list_transform(range(8), lambda i: 0::UBIGINT)),
    lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y >> 1, 3988292384::UBIGINT) ELSE y >> 1 END))"""

MANIFEST = f"""WITH RECURSIVE named AS (
  SELECT doc_id, source AS tree, {_leaf("text")} AS leaf,
    {_leaf(f"CASE WHEN doc_id IS NOT NULL AND xor({_CRC}, 4294967295::UBIGINT) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS now FROM documents
),
placed AS (
  SELECT *, leaf AS digest, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, now) - 1 AS rank, count(*) OVER (PARTITION BY tree) AS n FROM named
),
{_levels("nodes", "placed")},
subroots AS (SELECT tree, digest AS subroot FROM nodes WHERE n = 1),
sources AS (SELECT tree AS source, 0 AS tree, subroot AS digest, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS rank, count(*) OVER () AS n FROM subroots),
{_levels("tops", "sources")},
root AS (SELECT digest AS root FROM tops WHERE n = 1),
{_segments("beside", "nodes")},
{_segments("above", "tops")},
steps AS (
  SELECT p.doc_id, p.tree, p.rank, b.h, b.l, b.r FROM placed p JOIN beside b
    ON b.tree IS NOT DISTINCT FROM p.tree AND b.rank = p.rank // CAST(pow(3, b.h) AS BIGINT)
  UNION ALL
  SELECT p.doc_id, p.tree, p.rank, 100 + a.h, a.l, a.r FROM placed p JOIN sources s ON s.source IS NOT DISTINCT FROM p.tree JOIN above a
    ON a.rank = s.rank // CAST(pow(3, a.h) AS BIGINT)
),
paths AS (SELECT tree, rank, list({{'l': l, 'r': r}} ORDER BY h) AS path FROM steps GROUP BY tree, rank),
proved AS (
  SELECT p.doc_id, p.leaf, s.subroot, root, coalesce(x.path, []) AS path, p.now FROM placed p CROSS JOIN root
  JOIN subroots s ON s.tree IS NOT DISTINCT FROM p.tree LEFT JOIN paths x ON x.tree IS NOT DISTINCT FROM p.tree AND x.rank = p.rank
),
folded AS (
  SELECT *, list_reduce(list_prepend({{'l': now, 'r': ''}}, path), lambda d, s: {{'l': sha256(s.l || d.l || s.r), 'r': ''}}).l AS folded_root FROM proved
)
SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(path, lambda s: s.l || s.r), '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folded"""


METRIC_JOIN = """WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE CASE WHEN len(a.e) = len(b.e) THEN list_cosine_similarity(a.e, b.e) >= 0.98 ELSE FALSE END
),
reached(x, y) AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON l.x = r.y
),
counted AS (SELECT x, count(*) AS n FROM links GROUP BY x),
least AS (SELECT x, min(y) AS y FROM reached GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(y, vec_id)) AS component_id, vec_id <= coalesce(y, vec_id) AS kept
FROM embeddings LEFT JOIN counted ON counted.x = vec_id LEFT JOIN least ON least.x = vec_id"""


# Shingles of sets whose sizes are near enough are joined; what is reached over links is closed under them.
SET_JOIN = """WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) BETWEEN 1 AND 4 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingles FROM split
), sized AS (SELECT doc_id, shingles, len(shingles) AS n FROM sets),
listed AS (SELECT doc_id, n, unnest(shingles) AS shingle FROM sized),
links AS (
  SELECT a.doc_id, b.doc_id AS other FROM listed a JOIN listed b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sized
  UNION
  SELECT r.doc_id, l.other FROM reach r JOIN links l ON l.doc_id = r.other
)
SELECT s.doc_id, s.n AS n_shingles, min(r.other) AS component_id FROM sized s JOIN reach r USING (doc_id) GROUP BY ALL"""


def llm_checks() -> dict[str, str]:
    return {"op7_set_join": SET_JOIN, "op12_manifest": MANIFEST, "op13_metric_join": METRIC_JOIN}
