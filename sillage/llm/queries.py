"""Queries of the training-data operators: ``name -> (spark, sf_dir) -> DataFrame``.

Each reads its whole table with production parameters; SQL holds the DuckDB form where
SQL can express the operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (decontamination, embedding_dedup, html_extract, jaccard_join, line_dedup,
               mixing, piece_codec, pii, prefix_trie, quality, secrets, structure_repair, toxicity)
from .common import read, small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read(spark, sf_dir, "documents"))
    text = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.withColumn("spans", text)


@_query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_copies(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_removed").alias("n_removed"), "text")


@_query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(read(spark, sf_dir, "documents"))
    base = secrets.joined(F.filter("found", lambda s: s["rank"] < 3))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(base, 256).alias("base_sha256"),
                        secrets.joined(F.col("found")).alias("spans"))


@_query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


@_query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@_query
def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


@_query
def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@_query
def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


@_query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@_query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(read(spark, sf_dir, "pages"))


@_query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.nodes(*prefix_trie.rebuilt(prefix_trie.symbols(read(spark, sf_dir, "conversations"))))


@_query
def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read(spark, sf_dir, "conversations")
    found = structure_repair.report(structure_repair.repair(structure_repair.damaged(given)))
    ids = given.groupBy(F.col("conv_id").alias("id")).agg(F.lit(0).alias("none"))
    out = ids.join(found, F.col("id").eqNullSafe(found["conv_id"]), "left")
    return out.select(F.col("id").alias("conv_id"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


@_query
def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    small_batches(spark)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = piece_codec.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"), "agrees")


SQL["op2_line_dedup"] = r"""
WITH l AS (
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) AS pos, unnest(string_split(text, chr(10))) AS line
  FROM documents WHERE text IS NOT NULL),
c AS (
  SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY pos) AS cw
  FROM (SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n FROM l)),
reach AS (
  SELECT a.doc_id, a.pos AS s, b.pos AS e FROM c a JOIN c b
  ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.cw - a.cw + a.n >= 50),
runs AS (
  SELECT doc_id, s, min(e) AS e FROM reach GROUP BY doc_id, s
  UNION SELECT doc_id, max(s) AS s, e FROM reach GROUP BY doc_id, e),
body AS (
  SELECT r.doc_id, r.s, r.e, string_agg(c.line, chr(10) ORDER BY c.pos) AS t
  FROM runs r JOIN c ON c.doc_id = r.doc_id AND c.pos BETWEEN r.s AND r.e GROUP BY r.doc_id, r.s, r.e),
later AS (
  SELECT * FROM (
    SELECT *, row_number() OVER w AS k, first_value(doc_id) OVER w AS fd, first_value(s) OVER w AS fs
    FROM body WINDOW w AS (PARTITION BY t ORDER BY doc_id, s))
  WHERE k > 1 AND (doc_id <> fd OR s > fs + e - s)),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, e + 1)) AS pos FROM later),
per AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.pos) AS n_removed,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (g.pos IS NULL), '') AS text
  FROM l LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.pos = l.pos GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(p.n_lines, 0) AS n_lines, coalesce(p.n_removed, 0) AS n_removed, p.text
FROM documents d LEFT JOIN per p ON p.doc_id = d.doc_id
"""

SQL["op5_decontamination"] = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
i AS (
  SELECT DISTINCT item_id, k, array_to_string(w[p : p + k - 1], ' ') AS g
  FROM (SELECT item_id, w, least(5, len(w)) AS k, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS p FROM iw WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n_shingles FROM i GROUP BY item_id),
d AS (
  SELECT DISTINCT doc_id, k, array_to_string(w[p : p + k - 1], ' ') AS g
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM dw, (SELECT DISTINCT k FROM i) WHERE len(w) >= k))
SELECT d.doc_id, i.item_id, any_value(n.n_shingles) AS n_shingles, count(*) AS n_common
FROM d JOIN i ON d.g = i.g AND d.k = i.k JOIN n ON n.item_id = i.item_id
GROUP BY d.doc_id, i.item_id HAVING 5 * count(*) >= 4 * any_value(n.n_shingles)
"""

SQL["op6_source_mixing"] = r"""
WITH r AS (
  SELECT doc_id, source, md5(coalesce(doc_id::VARCHAR, '')) AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
per AS (
  SELECT *, 3.0 * source_size::DOUBLE AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5::DOUBLE WHEN 1 THEN 2::DOUBLE ELSE 1::DOUBLE END AS w
  FROM (SELECT source, sum(size)::BIGINT AS source_size FROM r GROUP BY source)),
lev AS (
  SELECT *, (sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lv,
         row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS k
  FROM per),
pick AS (SELECT lv AS level FROM lev WHERE lv * w <= cap ORDER BY k LIMIT 1),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT level FROM pick) * w, cap))::DOUBLE AS target FROM lev),
p AS (
  SELECT r.*, t.source_size, t.target, floor(t.target + 0.5)::BIGINT AS budget,
         coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM r JOIN t ON r.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN (budget // source_size) * size + least(greatest(budget % source_size - start, 0), size) ELSE 0 END)::BIGINT AS taken
FROM p
"""

SQL["op11_prefix_trie"] = r"""
WITH t AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))),
o AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, xor(list_reduce([4294967295] || list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT),
                      lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM o), t),
b AS (
  SELECT c.conv_id, o.role, o.text, o.pos FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 5 AND o.pos <= c.h
  UNION ALL SELECT c.conv_id, o.role, o.text, o.pos + 8 FROM c JOIN o ON o.conv_id = c.conv_id AND o.pos > c.h),
r AS (
  SELECT conv_id, row_number() OVER w AS d, strlen(text) AS bytes, count(*) OVER (PARTITION BY conv_id) AS n,
         string_agg(concat(strlen(role), ':', role, strlen(text), ':', text), '') OVER (w ROWS UNBOUNDED PRECEDING) AS p
  FROM b WINDOW w AS (PARTITION BY conv_id ORDER BY pos)
  UNION ALL SELECT conv_id, 0, 0, (SELECT count(*) FROM b WHERE b.conv_id = c.conv_id), '' FROM c),
v AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM r GROUP BY p, d),
e AS (SELECT v.p, v.d, u.p AS up, u.conv_id AS parent FROM v JOIN r ON r.conv_id = v.conv_id AND r.d = v.d - 1 JOIN v u ON u.p = r.p AND u.d = r.d),
k AS (SELECT up AS p, d - 1 AS d, count(*) AS n FROM e GROUP BY up, d),
s AS (
  SELECT r.p, r.d, sum((v.n_convs - 1) * v.bytes) AS saved, count(*) FILTER (k.n IS NULL) AS leaves
  FROM v JOIN r ON r.conv_id = v.conv_id AND r.d <= v.d LEFT JOIN k ON k.p = v.p AND k.d = v.d GROUP BY r.p, r.d)
SELECT v.conv_id, v.d AS depth, e.parent AS parent_conv_id, v.n_convs, coalesce(k.n, 0) AS n_children, s.leaves AS n_leaves,
       s.saved::BIGINT AS saved_tokens, v.ends_sha256
FROM v JOIN s ON s.p = v.p AND s.d = v.d LEFT JOIN e ON e.p = v.p AND e.d = v.d LEFT JOIN k ON k.p = v.p AND k.d = v.d
"""
