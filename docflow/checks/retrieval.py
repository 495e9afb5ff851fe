"""Registered queries on vectors and on sections of documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from docflow.checks.shapes import table
from docflow.operators import compare, retrieval

NEIGHBOURS = 10


def vector_topk(spark, sf):
    """Every twentieth row asks all rows."""
    rows = table(spark, sf, "embeddings")
    return retrieval.exact_topk(rows.filter(F.col("vec_id") % 20 == 0), rows, "vec_id", "embedding", NEIGHBOURS)


def vector_index_topk(spark, sf):
    """The same through the index. The given vectors have no clusters, so most cells are probed; see the measured recall in the tests."""
    rows = table(spark, sf, "embeddings")
    quantizer = retrieval.train(rows, "vec_id", "embedding", parts=32)
    indexed = retrieval.index(rows, "vec_id", "embedding", quantizer)
    probes = round(0.7 * len(quantizer.cells))
    return retrieval.index_topk(
        rows.filter(F.col("vec_id") % 20 == 0), rows, indexed, quantizer, "vec_id", "embedding", NEIGHBOURS, probes=probes, again=150
    )


def section_compare(spark, sf):
    """All documents, a section a line, beside a version in which lines are left out, reworded, moved down and put in."""
    lines = table(spark, sf, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("p", "text")).withColumn("p", F.col("p").cast("long"))
    lines = lines.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    turn = F.pmod(F.col("p") + F.col("doc_id"), F.lit(11))
    reworded = F.when(turn == 5, F.concat(F.lit("reworded "), "text")).otherwise(F.col("text"))
    kept = lines.filter(turn != 3).select("doc_id", (4 * F.col("p") + F.when(turn == 7, 26).otherwise(0)).alias("p"), reworded.alias("text"))
    put_in = lines.filter(turn == 9).select("doc_id", (4 * F.col("p") + 1).alias("p"), F.concat(F.lit("new "), F.md5("text")).alias("text"))
    return compare.compare_sections(lines, kept.unionByName(put_in), ["doc_id"], "p", "text")


QUERIES = {"vector_topk": vector_topk, "vector_index_topk": vector_index_topk, "section_compare": section_compare}

SECTION_COMPARE = r"""
WITH RECURSIVE line AS (
  SELECT doc_id, p::BIGINT AS p, ls[p + 1] AS text FROM (SELECT doc_id, ls, unnest(range(0, len(ls))) AS p FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))
  WHERE regexp_matches(ls[p + 1], '[^\x20\x09-\x0D]')
),
turn AS (SELECT *, (p + doc_id) % 11 AS t FROM line),
version AS (
  SELECT doc_id, 4 * p + CASE WHEN t = 7 THEN 26 ELSE 0 END AS p, CASE WHEN t = 5 THEN 'reworded ' || text ELSE text END AS text FROM turn WHERE t <> 3
  UNION ALL SELECT doc_id, 4 * p + 1, 'new ' || md5(text) FROM turn WHERE t = 9
),
a AS (SELECT *, row_number() OVER (PARTITION BY doc_id, text ORDER BY p) AS k FROM line),
b AS (SELECT *, row_number() OVER (PARTITION BY doc_id, text ORDER BY p) AS k FROM version),
equal AS (SELECT doc_id, a.p AS i, b.p AS j FROM a JOIN b USING (doc_id, text, k)),
x AS (SELECT doc_id, p AS i, list_distinct(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w FROM a WHERE (doc_id, p) NOT IN (SELECT (doc_id, i) FROM equal)),
y AS (SELECT doc_id, p AS j, list_distinct(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w FROM b WHERE (doc_id, p) NOT IN (SELECT (doc_id, j) FROM equal)),
xt AS (SELECT doc_id, i, unnest(w) AS term FROM x),
yt AS (SELECT doc_id, j, unnest(w) AS term FROM y),
met AS (SELECT DISTINCT doc_id, i, j FROM xt JOIN yt USING (doc_id, term)),
alike AS (
  SELECT doc_id, i, j, least(1000 * c // (len(x.w) + len(y.w) - c), 999)::BIGINT AS weight
  FROM (SELECT met.*, len(list_intersect(x.w, y.w)) AS c, x, y FROM met JOIN x USING (doc_id, i) JOIN y USING (doc_id, j))
),
pair AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i, j) AS n
  FROM (SELECT doc_id, i, j, 1000::BIGINT AS weight FROM equal UNION ALL SELECT * FROM alike WHERE weight >= 500)
),
walk AS (
  SELECT doc_id, 0::BIGINT AS n, []::STRUCT(best BIGINT, m BIGINT, i BIGINT, j BIGINT, n BIGINT, prev BIGINT)[] AS seen FROM (SELECT DISTINCT doc_id FROM pair)
  UNION ALL
  SELECT doc_id, n, list_append(seen, {'best': weight + coalesce(top.best, 0), 'm': -n, 'i': i, 'j': j, 'n': n, 'prev': coalesce(-top.m, 0)}) FROM (
    SELECT w.doc_id, p.n, p.i, p.j, p.weight, w.seen, list_max(list_filter(w.seen, lambda s: s.i < p.i AND s.j < p.j)) AS top
    FROM walk w JOIN pair p ON p.doc_id = w.doc_id AND p.n = w.n + 1
  )
),
final AS (SELECT doc_id, arg_max(seen, n) AS seen FROM walk GROUP BY doc_id),
chain AS (
  SELECT doc_id, seen, list_max(seen).n AS n FROM final
  UNION ALL SELECT doc_id, seen, seen[n].prev FROM chain WHERE seen[n].prev > 0
),
placed AS (
  SELECT doc_id, CASE WHEN chain.n IS NULL THEN 'moved' WHEN weight = 1000 THEN 'same' ELSE 'changed' END AS change, i AS old_position, j AS new_position, weight AS similarity
  FROM pair LEFT JOIN chain USING (doc_id, n) WHERE chain.n IS NOT NULL OR weight = 1000
)
SELECT * FROM placed
UNION ALL SELECT doc_id, 'removed', p, NULL, NULL FROM line WHERE (doc_id, p) NOT IN (SELECT (doc_id, old_position) FROM placed)
UNION ALL SELECT doc_id, 'added', NULL, p, NULL FROM version WHERE (doc_id, p) NOT IN (SELECT (doc_id, new_position) FROM placed)
"""

ORACLE = {
    "section_compare": SECTION_COMPARE,
    "vector_topk": f"""SELECT query, rank::INTEGER AS rank, key, score FROM (
  SELECT q.vec_id AS query, c.vec_id AS key, round(list_cosine_similarity(q.embedding::DOUBLE[], c.embedding::DOUBLE[]), 9) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY score DESC, c.vec_id) AS rank
  FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
) WHERE rank <= {NEIGHBOURS}""",
}
