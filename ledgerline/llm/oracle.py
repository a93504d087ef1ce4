"""The same questions as SQL for DuckDB, where SQL can ask them."""

from __future__ import annotations


def _written(column: str) -> str:
    text = f"CAST({column} AS VARCHAR)"
    return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen({text})::VARCHAR || ':' || {text} END"


def _head() -> str:
    return " || ".join(_written(c) for c in ("doc_id", "source", "lang", "n_chars"))


MERKLE_MANIFEST = f"""
WITH RECURSIVE bits(doc_id, step, bytes, crc) AS (
  SELECT doc_id, 0, CAST(doc_id AS VARCHAR), 4294967295::BIGINT FROM documents WHERE doc_id IS NOT NULL
  UNION ALL
  SELECT doc_id, step + 1, bytes, CASE WHEN started % 2 = 1 THEN xor(started // 2, 3988292384) ELSE started // 2 END
  FROM (SELECT *, CASE WHEN step % 8 = 0 THEN xor(crc, ascii(substr(bytes, step // 8 + 1, 1))::BIGINT) ELSE crc END AS started
    FROM bits WHERE step < 8 * length(bytes))
), tampered AS (
  SELECT DISTINCT doc_id FROM bits WHERE step = 8 * length(bytes) AND xor(crc, 4294967295) % 5 = 0
), texts AS (
  SELECT doc_id, source, {_head()} AS head, text, doc_id IN (FROM tampered) AS claims FROM documents
), leaves AS (
  SELECT doc_id, source, sha256(head || {_written('text')}) AS leaf, sha256(head || {_written('low')}) AS claimed FROM
    (SELECT *, CASE WHEN claims THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS low FROM texts)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree FROM leaves
), level(tree, depth, place, h, n) AS (
  SELECT tree, 0, place, leaf, n FROM placed
  UNION ALL
  SELECT tree, any_value(depth) + 1, place // 16, sha256(string_agg(h, '' ORDER BY place)), (any_value(n) + 15) // 16
  FROM level WHERE n > 1 GROUP BY tree, place // 16
), subroots AS (SELECT tree, h AS subroot FROM level WHERE n = 1),
top(depth, place, h, n) AS (
  SELECT 0, tree, subroot, (SELECT count(*) FROM subroots) FROM subroots
  UNION ALL
  SELECT any_value(depth) + 1, place // 16, sha256(string_agg(h, '' ORDER BY place)), (any_value(n) + 15) // 16
  FROM top WHERE n > 1 GROUP BY place // 16
), nodes AS (
  SELECT tree, depth, place, h, n FROM level UNION ALL SELECT -1, depth, place, h, n FROM top
), runs AS (
  SELECT tree, depth, place // 16 AS up, any_value(n) AS n, string_agg(h, '' ORDER BY place) AS run FROM nodes GROUP BY tree, depth, place // 16
), climb(row_tree, row_place, tree, depth, place, folded, proof) AS (
  SELECT tree, place, tree, 0, place, claimed, '' FROM placed
  UNION ALL
  SELECT row_tree, row_place, CASE WHEN n = 1 THEN -1 ELSE r.tree END, CASE WHEN n = 1 THEN 0 ELSE r.depth + 1 END,
    CASE WHEN n = 1 THEN r.tree ELSE up END,
    CASE WHEN n = 1 THEN folded ELSE sha256(substr(run, 1, 64 * (place % 16)) || folded || substr(run, 64 * (place % 16 + 1) + 1)) END,
    CASE WHEN n = 1 THEN proof ELSE proof || substr(run, 1, 64 * (place % 16)) || substr(run, 64 * (place % 16 + 1) + 1) END
  FROM climb c JOIN runs r ON c.tree = r.tree AND c.depth = r.depth AND c.place // 16 = r.up
  WHERE NOT (r.tree = -1 AND n = 1)
), ends AS (
  SELECT c.* FROM climb c JOIN runs r ON c.tree = -1 AND r.tree = -1 AND c.depth = r.depth AND r.n = 1
)
SELECT p.doc_id, p.leaf, s.subroot, t.h AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = t.h AS verified
FROM placed p JOIN ends e ON p.tree = e.row_tree AND p.place = e.row_place JOIN subroots s ON p.tree = s.tree
JOIN top t ON t.n = 1
"""


TOP_K = """
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM kept q JOIN kept c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5
"""

SUBSTRING_DEDUP = r"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS row, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words FROM documents
), windows AS (
  SELECT row, i, array_to_string(words[i : i + 34], ' ') AS words FROM texts, unnest(range(1, len(words) - 33)) AS t(i)
), repeated AS (
  SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY words) AS n FROM windows) AS w WHERE n > 1
), removed AS (
  SELECT DISTINCT row, unnest(range(i, i + 35)) AS k FROM repeated
), kept AS (
  SELECT t.row, string_agg(t.words[k], ' ' ORDER BY k) AS text FROM texts t, unnest(range(1, len(t.words) + 1)) AS u(k)
  WHERE NOT EXISTS (FROM removed r WHERE r.row = t.row AND r.k = u.k) GROUP BY t.row
)
SELECT doc_id, len(words) AS n_words, (SELECT count(*) FROM removed r WHERE r.row = t.row) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept ON t.row = kept.row
"""


def _vector_codes(rounds: int = 4) -> str:
    assigned = """
      SELECT i, p, x, CAST(min((list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c)) * 256 + e) AS BIGINT) AS best
      FROM parts JOIN book{n} USING (p) GROUP BY i, p, x
    """
    steps = []
    for n in range(rounds + 1):
        steps.append(f"near{n} AS MATERIALIZED ({assigned.format(n=n)})")
        if n < rounds:
            steps.append(
                f"""mean{n} AS (
      SELECT p, e, list(m ORDER BY k) AS c FROM (
        SELECT p, best % 256 AS e, k, floor(sum(x[k]) / count(*)) AS m FROM near{n}, unnest(range(1, len(x) + 1)) AS t(k) GROUP BY p, best % 256, k
      ) AS s GROUP BY p, e
    ), book{n + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{n} AS b LEFT JOIN mean{n} AS m USING (p, e))"""
            )
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS i FROM kept
), parts AS MATERIALIZED (
  SELECT i, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS x FROM numbered, range(4) AS t(p)
), book0 AS (SELECT p, i AS e, x AS c FROM parts WHERE i < 256),
{", ".join(steps)},
books AS (
  SELECT sha256(string_agg(CAST(CAST(c[k] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, k)) AS codebooks_sha256
  FROM book{rounds} AS b, unnest(range(1, len(c) + 1)) AS t(k)
), coded AS (
  SELECT i, string_agg(format('{{:02x}}', best % 256), '' ORDER BY p) AS code, CAST(sum(best // 256) AS BIGINT) AS error FROM near{rounds} GROUP BY i
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM numbered JOIN coded USING (i), books
"""


VECTOR_CODES = _vector_codes()
