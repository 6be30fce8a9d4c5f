"""The queries of the numbered operators and the pipeline, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from saltmarsh.llm import decontaminate, fingerprints, html_text, licenses, mixing, near_dups, negatives, quality, token_counts, tokens, trie, urls, warc

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op5_minhash_near_dups(spark, sf_dir):
    return near_dups.near_duplicates(read(spark, sf_dir, "documents"), width=3, percent=85)


@query
def op9_quality(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, read(spark, sf_dir, "labels"))
    scored = quality.score(docs, model, "text", ["doc_id"])
    return scored.select("doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op4_mix_sources(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents"))


ORACLE["op4_mix_sources"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS nr FROM d GROUP BY source
), w AS (
  SELECT *, CASE (nr - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s
), f AS (
  SELECT *, row_number() OVER (ORDER BY 3 * source_size / weight, nr) AS pos,
         ((sum(source_size) OVER ()) - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, nr ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / (sum(weight) OVER (ORDER BY 3 * source_size / weight, nr ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM w
), o AS (SELECT min(pos) AS pos FROM f WHERE 3 * source_size >= weight * level
), t AS (
  SELECT f.source, f.source_size,
         CASE WHEN f.pos < o.pos THEN (3 * f.source_size)::DOUBLE ELSE f.weight * (SELECT level FROM f AS g WHERE g.pos = o.pos) END AS target
  FROM f, o
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies FROM t
), r AS (
  SELECT d.doc_id, d.size, d.h, p.source_size, p.target, p.copies, floor(p.target)::BIGINT - p.copies * p.source_size AS rest,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE UNBOUNDED PRECEDING)::BIGINT AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.h)::BIGINT AS same
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       (copies * size + CASE WHEN upto <= rest THEN size WHEN upto - same >= rest THEN 0 ELSE ((rest - upto + same)::HUGEINT * size // same) END)::BIGINT AS taken
FROM r
"""


@query
def op6_decontaminate(spark, sf_dir):
    return decontaminate.benchmark_matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op8_url_filter(spark, sf_dir):
    return urls.filter_urls(read(spark, sf_dir, "pages"))


@query
def op3_token_files(spark, sf_dir):
    import public_tokenizers

    return tokens.token_files(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op1_main_text(spark, sf_dir):
    return html_text.extract_text(read(spark, sf_dir, "pages"))


@query
def op7_fingerprints(spark, sf_dir):
    return fingerprints.fingerprints(read(spark, sf_dir, "documents"))


@query
def op2_edited_token_counts(spark, sf_dir):
    """Three edits a document: a stretch from its start put in for ten characters at a third, five characters
    gone in the middle, and two words put in front."""
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    n = F.length("text").cast("long")

    def edit(seq, at, delete, insert):
        return F.struct(F.lit(seq).cast("long").alias("seq"), at.cast("long").alias("at"), F.lit(delete).cast("long").alias("delete"), insert.alias("insert"))

    edits = F.array(
        edit(0, F.floor(n / 3), 10, F.substring("text", 1, 40)),
        edit(1, F.floor(n / 2), 5, F.lit("")),
        edit(2, F.lit(0), 0, F.lit("As follows: ")),
    )
    return token_counts.edited_counts(docs, edits, public_tokenizers.path("byte_bpe_50k.json"))


@query
def op10_license_scan(spark, sf_dir):
    """Documents as files: source/lang/k/doc_id with a hundred ids to a folder k; the first document of each folder, and of
    each source and language, stands as its licence file."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", F.coalesce("source", F.lit("none")).alias("s"), F.coalesce("lang", F.lit("none")).alias("l"))
    docs = docs.withColumn("k", F.floor(F.col("doc_id") / 100).cast("string"))
    first = docs.groupBy("s", "l", "k").agg(F.min("doc_id").alias("f3"))
    second = first.groupBy("s", "l").agg(F.min("f3").alias("f2"))
    heads = first.join(second, ["s", "l"])
    at = F.when(F.col("doc_id") == F.col("f2"), F.concat_ws("/", "s", "l", F.lit("LICENSE"))).when(F.col("doc_id") == F.col("f3"), F.concat_ws("/", "s", "l", "k", F.lit("LICENSE")))
    files = docs.join(F.broadcast(heads) if heads.count() <= 500_000 else heads, ["s", "l", "k"], "left")
    return licenses.scan_licenses(files.withColumn("path", F.coalesce(at, F.concat_ws("/", "s", "l", "k", "doc_id"))))


@query
def op11_warc(spark, sf_dir):
    return warc.page_records(read(spark, sf_dir, "pages"))


ORACLE["op11_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), d AS (
  SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest, max(page_id) OVER (PARTITION BY body) AS kept FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM kept THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id IS DISTINCT FROM kept THEN kept END AS refers_to
FROM d
"""


@query
def op12_hard_negatives(spark, sf_dir):
    """Every seventh vector is labelled as the next class; every hundredth is an anchor."""
    rows = negatives.usable_rows(read(spark, sf_dir, "embeddings"))
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(rows.withColumn("label", moved), F.col("id") % 100 == 0)


ORACLE["op12_hard_negatives"] = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, e.vec_id AS other_id, a.label = e.label AS same, list_inner_product(a.v, e.v)::BIGINT AS score
  FROM e AS a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
), n AS (
  SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""


@query
def op13_prefix_trie(spark, sf_dir):
    return trie.prefix_trie(read(spark, sf_dir, "conversations"))


ORACLE["op13_prefix_trie"] = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), s AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS first,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
           lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))) % 9 AS h
  FROM t GROUP BY conv_id
), c AS (
  SELECT s.conv_id, s.first, s.h, least(s.h, coalesce(f.n, 0)) AS held FROM s LEFT JOIN s AS f ON f.conv_id = s.first
), r AS (
  SELECT c.conv_id, t.pos AS p, t.role, t.text FROM c JOIN t ON t.conv_id = c.first AND t.pos < c.h
  UNION ALL SELECT c.conv_id, t.pos - c.h + c.held, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos >= c.h
), k AS (
  SELECT conv_id, p + 1 AS depth, text,
         sha256(string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER (PARTITION BY conv_id ORDER BY p)) AS node
  FROM r UNION ALL SELECT conv_id, 0, '', '' FROM c
), n AS (
  SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(octet_length(encode(text))) AS own FROM k GROUP BY depth, node
), b AS (
  SELECT n.depth, n.node, u.node AS above, n.own FROM n LEFT JOIN k AS u ON u.conv_id = n.conv_id AND u.depth = n.depth - 1
), ch AS (
  SELECT depth - 1 AS depth, above AS node, count(*) AS n_children FROM b WHERE depth > 0 GROUP BY ALL
), sub AS (
  SELECT k.depth, k.node, sum(n.own) AS saved, count(*) FILTER (ch.node IS NULL) AS n_leaves
  FROM n JOIN k ON k.conv_id = n.conv_id AND k.depth <= n.depth LEFT JOIN ch ON ch.depth = n.depth AND ch.node = n.node GROUP BY k.depth, k.node
), e AS (
  SELECT depth, node, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids FROM k
  WHERE depth = (SELECT max(m.depth) FROM k AS m WHERE m.conv_id = k.conv_id) GROUP BY depth, node
)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n_children, 0) AS n_children, sub.n_leaves,
       sub.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM n JOIN b ON b.depth = n.depth AND b.node = n.node JOIN sub ON sub.depth = n.depth AND sub.node = n.node
LEFT JOIN n AS u ON u.depth = n.depth - 1 AND u.node = b.above LEFT JOIN ch ON ch.depth = n.depth AND ch.node = n.node LEFT JOIN e ON e.depth = n.depth AND e.node = n.node
"""
