"""Retrieval, evaluation and operations logs (inventory 2.10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scale import top_per_key
from ..operators import cells as ce
from ..operators import evaluation as ev
from ..operators import retrieval as rt
from ..operators import textops as tx
from ..session import cut_lineage
from ..sources import adapters as ad
from ..sources import tables as src
from .documents import joined
from .oracle import with_
from .registry import query, rnd, text
from .windows import PAIRS_SQL, answered


def now():
    return F.lit(ad.AS_OF).cast("timestamp_ntz")


def docs(spark, d):
    return src.table(spark, d, "documents")


@query("topk_per_query", "SELECT source, doc_id, n_chars, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS INT) AS rank FROM documents) WHERE rank <= 3")
def topk_per_query(spark, d):
    rows = docs(spark, d).select("source", "doc_id", "n_chars")
    return top_per_key(rows, ["source"], [F.col("n_chars").desc(), "doc_id"], 3)


# ---- chunks


@query("chunk_fixed", """SELECT doc_id, CAST((s - 1) / 250 AS INT) AS chunk_index, md5(substring(text, s, 300)) AS digest FROM (SELECT doc_id, text, CAST(unnest(generate_series(1, greatest(length(text), 1), 250)) AS BIGINT) AS s FROM documents)""")
def chunk_fixed(spark, d):
    out = rt.fixed_chunks(docs(spark, d).select("doc_id", "text"), "text", 300, 50)
    return out.select("doc_id", "chunk_index", F.md5("chunk").alias("digest"))


@query("chunk_recursive")
def chunk_recursive(spark, d):
    out = rt.recursive_chunks(docs(spark, d).select("doc_id", "source", "text"), "text", 300, 50)
    return out.select("doc_id", "source", "chunk_index", F.length("chunk").alias("chunk_chars"), F.md5("chunk").alias("digest"))


@query("chunk_sections", """WITH m AS (SELECT page_id, string_split(regexp_replace(regexp_replace(html, '<h1>|<p>', chr(10) || '## ', 'g'), '\\n## ', chr(10) || chr(1) || '## ', 'g'), chr(1)) AS parts FROM pages),
s AS (SELECT page_id, list_filter(parts, lambda x: x <> '') AS parts FROM m)
SELECT page_id, CAST(i - 1 AS INT) AS chunk_index, md5(parts[i]) AS digest FROM (SELECT page_id, parts, unnest(generate_series(1, len(parts))) AS i FROM s)""")
def chunk_sections(spark, d):
    marked = src.table(spark, d, "pages").select("page_id", F.regexp_replace("html", "<h1>|<p>", "\n## ").alias("text"))
    return rt.section_chunks(marked, "text").select("page_id", "chunk_index", F.md5("chunk").alias("digest"))


@query("chunk_metadata", """SELECT source, count(*) AS chunks, count(DISTINCT doc_id) AS documents, CAST(max(s) AS INT) AS last_index FROM (SELECT source, doc_id, unnest(generate_series(0, (greatest(length(text), 1) - 1) // 250)) AS s FROM documents) GROUP BY 1""")
def chunk_metadata(spark, d):
    out = rt.fixed_chunks(docs(spark, d).select("doc_id", "source", "text"), "text", 300, 50)
    per_doc = out.groupBy("source", "doc_id").agg(F.count("*").alias("c"), F.max("chunk_index").alias("m"))
    return per_doc.groupBy("source").agg(F.sum("c").alias("chunks"), F.count("*").alias("documents"), F.max("m").alias("last_index"))


@query("hash_embed", """WITH h AS (SELECT doc_id, list_transform(generate_series(1, 16), lambda i: CAST(('0x' || substr(md5(md5(text) || i), 1, 8)) AS BIGINT) / 4294967296.0::DOUBLE - 0.5) AS v FROM documents),
n AS (SELECT doc_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM h)
SELECT doc_id, round(v[1] / norm, 6) AS first, round(v[16] / norm, 6) AS last FROM n""")
def hash_embed(spark, d):
    vec = docs(spark, d).select("doc_id", tx.unit(rt.hash_vector(F.col("text"), 16)).alias("v"))
    return vec.select("doc_id", rnd(F.get("v", 0)).alias("first"), rnd(F.element_at("v", -1)).alias("last"))


# ---- search

CENTROID_SQL = """WITH x AS (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
c AS (SELECT label AS query_id, list(m ORDER BY i) AS q FROM (SELECT label, i, avg(v) AS m FROM x GROUP BY 1, 2) GROUP BY 1),
s AS (SELECT query_id, vec_id AS id, e.label, round(list_cosine_similarity(CAST(embedding AS DOUBLE[]), q), 9) AS score FROM embeddings e, c),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INT) AS rank FROM s)
"""


def nearest(spark, d, k):
    vectors = src.table(spark, d, "embeddings")
    return rt.similarity_search(vectors, rt.label_centroids(vectors), k)


@query("similarity_search", CENTROID_SQL + "SELECT CAST(query_id AS BIGINT) AS query_id, id, round(score, 6) AS score, rank FROM r WHERE rank <= 10")
def similarity_search(spark, d):
    return nearest(spark, d, 10).withColumn("score", rnd("score"))


@query("retrieval_metrics", CENTROID_SQL + """, n AS (SELECT label, count(*) AS n FROM embeddings GROUP BY 1)
SELECT CAST(query_id AS BIGINT) AS query_id, count(*) FILTER (WHERE r.label = query_id) AS hits, round(count(*) FILTER (WHERE r.label = query_id) / 10.0::DOUBLE, 6) AS precision_at_k,
 round(count(*) FILTER (WHERE r.label = query_id) / CAST(any_value(n.n) AS DOUBLE), 6) AS recall_at_k FROM r JOIN n ON r.query_id = n.label WHERE rank <= 10 GROUP BY query_id""")
def retrieval_metrics(spark, d):
    labels = src.table(spark, d, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("bigint").alias("label"))
    truth = labels.groupBy(F.col("label").alias("query_id")).agg(F.count("*").alias("n"))
    hits = nearest(spark, d, 10).join(labels, "id").groupBy("query_id").agg(F.count_if(F.col("label") == F.col("query_id")).alias("hits"), F.count("*").alias("k"))
    out = hits.join(truth, "query_id")
    return out.select("query_id", "hits", rnd(F.col("hits") / F.col("k")).alias("precision_at_k"), rnd(F.col("hits") / F.col("n")).alias("recall_at_k"))


CELLS, PROBES = 32, 24


@query("similarity_search_cells")
def similarity_search_cells(spark, d):
    """Every twentieth vector against all, through the cell index."""
    vectors = src.table(spark, d, "embeddings")
    asked = vectors.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query"))
    return ce.search_cells(ce.build_cells(vectors, CELLS), asked, 10, PROBES).withColumn("score", rnd("score"))


SEARCHES = {"insults": ["trash", "stupid", "clown"], "english": ["hate", "from", "with"], "german": ["nicht", "auf", "trash"], "spanish": ["para", "por", "stupid"]}


def bm25_sql(searches):
    terms = ", ".join(f"('{q}', '{t}')" for q, words in searches.items() for t in words)
    return f"""WITH q(query_id, term) AS (VALUES {terms}), t AS (SELECT doc_id, source, text, regexp_extract_all(lower(text), '\\p{{L}}+') AS bag FROM documents),
l AS (SELECT doc_id, len(bag) AS len FROM t), st AS (SELECT count(*) AS n, avg(len) AS avg_len FROM l),
tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(bag) AS term FROM t) WHERE term IN (SELECT term FROM q) GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
w AS (SELECT tf.doc_id, tf.term, ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * len / avg_len)) AS w FROM tf JOIN df ON tf.term = df.term JOIN l ON tf.doc_id = l.doc_id, st),
s AS (SELECT query_id, doc_id AS id, round(sum(w), 9) AS score FROM w JOIN q ON w.term = q.term GROUP BY 1, 2),
bm AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INT) AS rank FROM s WHERE score > 0)
"""


@query("bm25_search", bm25_sql(SEARCHES) + "SELECT query_id, id, round(score, 6) AS score, rank FROM bm WHERE rank <= 10")
def bm25_search(spark, d):
    return rt.bm25(docs(spark, d), SEARCHES, 10).withColumn("score", rnd("score"))


@query("rag_context", bm25_sql(SEARCHES) + """SELECT query_id, md5(string_agg('[From ' || source || ']' || chr(10) || text, chr(10) || chr(10) ORDER BY rank)) AS digest, string_agg(source, ',' ORDER BY rank) AS sources FROM bm JOIN t ON bm.id = t.doc_id WHERE rank <= 3 GROUP BY 1""")
def rag_context(spark, d):
    out = rt.context_block(rt.bm25(docs(spark, d), SEARCHES, 3), docs(spark, d))
    return out.select("query_id", F.md5("context").alias("digest"), "sources")


#: Every label's centroid goes with one of the keyword queries, in turn.
WORD_QUERIES = list(SEARCHES)


@query("hybrid_search", bm25_sql(SEARCHES) + ", " + CENTROID_SQL[5:].replace("c AS", "cc AS").replace("x AS", "xx AS").replace("FROM x ", "FROM xx ").replace(" e, c)", " e, cc)").replace("s AS (SELECT query_id, vec_id", "vs AS (SELECT query_id, vec_id").replace("FROM s)", "FROM vs)") + """,
a AS (SELECT CAST(query_id AS BIGINT) AS query_id, id, rank FROM r WHERE rank <= 20),
lab AS (SELECT DISTINCT query_id, CASE query_id % 4 WHEN 0 THEN 'insults' WHEN 1 THEN 'english' WHEN 2 THEN 'german' ELSE 'spanish' END AS name FROM a),
b AS (SELECT lab.query_id, bm.id, bm.rank FROM bm JOIN lab ON bm.query_id = lab.name WHERE rank <= 20),
f AS (SELECT coalesce(a.query_id, b.query_id) AS query_id, coalesce(a.id, b.id) AS id, a.rank AS rank_a, b.rank AS rank_b, round(coalesce(1.0::DOUBLE / (60 + a.rank), 0) + coalesce(1.0::DOUBLE / (60 + b.rank), 0), 12) AS score FROM a FULL JOIN b ON a.query_id = b.query_id AND a.id = b.id),
g AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS INT) AS rank FROM f)
SELECT query_id, id, rank_a, rank_b, round(score, 8) AS score, rank FROM g WHERE rank <= 10""")
def hybrid_search(spark, d):
    by_vector = nearest(spark, d, 20)
    name = F.element_at(F.array(*[F.lit(q) for q in WORD_QUERIES]), (F.col("query_id") % len(WORD_QUERIES) + 1).cast("int"))
    labels = by_vector.select("query_id").distinct().withColumn("name", name)
    found = rt.bm25(docs(spark, d), SEARCHES, 20).withColumnRenamed("query_id", "name")
    by_word = found.join(labels, "name").select("query_id", "id", "rank")
    return rt.fuse_ranks(by_vector, by_word, 10).withColumn("score", rnd("score", 8))


SYNONYMS = [("trash", "worthless"), ("stupid", "disgusting"), ("hate", "clown"), ("nicht", "nur")]


@query("query_expansion", bm25_sql(SEARCHES).split(",\nl AS")[0] + f""", syn(term, synonym) AS (VALUES {', '.join(map(str, SYNONYMS))}),
x AS (SELECT query_id, term, min(added) AS added FROM (SELECT query_id, term, 0 AS added FROM q UNION ALL SELECT query_id, synonym, 1 FROM q JOIN syn ON q.term = syn.term) GROUP BY 1, 2),
u AS (SELECT doc_id, unnest(list_distinct(bag)) AS term FROM t), m AS (SELECT query_id, doc_id, min(added) AS added FROM u JOIN x ON u.term = x.term GROUP BY 1, 2)
SELECT query_id, count(*) AS found, count(*) FILTER (WHERE added = 0) AS found_without FROM m GROUP BY 1""")
def query_expansion(spark, d):
    terms = spark.createDataFrame([(q, t) for q, words in SEARCHES.items() for t in words], "query_id string, term string")
    wanted = rt.expand_queries(terms, spark.createDataFrame(SYNONYMS, "term string, synonym string"))
    vocab = sorted({t for w in SEARCHES.values() for t in w} | {s for _, s in SYNONYMS})
    bag = F.array_distinct(F.filter(rt.tokens(F.col("text")), lambda t: t.isin(vocab)))
    found = docs(spark, d).select("doc_id", F.explode(bag).alias("term")).join(wanted, "term")
    per_doc = found.groupBy("query_id", "doc_id").agg(F.min("added").alias("added"))
    return per_doc.groupBy("query_id").agg(F.count("*").alias("found"), F.count_if(F.col("added") == 0).alias("found_without"))


@query("text_similarity_metrics", PAIRS_SQL + """, e1 AS (SELECT conv_id, interaction, tok, count(*) AS n FROM (SELECT conv_id, interaction, unnest(regexp_extract_all(lower(input), '\\p{L}+')) AS tok FROM pr) GROUP BY 1, 2, 3),
a1 AS (SELECT conv_id, interaction, tok, count(*) AS n FROM (SELECT conv_id, interaction, unnest(regexp_extract_all(lower(output), '\\p{L}+')) AS tok FROM pr) GROUP BY 1, 2, 3),
j AS (SELECT coalesce(e1.conv_id, a1.conv_id) AS user_id, coalesce(e1.interaction, a1.interaction) AS interaction, sum(least(coalesce(e1.n, 0), coalesce(a1.n, 0))) AS common, sum(e1.n) AS ne, sum(a1.n) AS na FROM e1 FULL JOIN a1 ON e1.conv_id = a1.conv_id AND e1.interaction = a1.interaction AND e1.tok = a1.tok GROUP BY 1, 2),
k AS (SELECT user_id, interaction, common / CAST(ne AS DOUBLE) AS r, common / CAST(na AS DOUBLE) AS p FROM j)
SELECT user_id, interaction, round(r, 6) AS rouge1_recall, round(p, 6) AS bleu1_precision, round(CASE WHEN r + p > 0 THEN 2 * r * p / (r + p) ELSE 0 END, 6) AS rouge1_f1 FROM k""")
def text_similarity_metrics(spark, d):
    out = rt.token_overlap_metrics(answered(spark, d), ["user_id", "interaction"], "input", "output")
    return out.select("user_id", "interaction", rnd("recall").alias("rouge1_recall"), rnd("precision").alias("bleu1_precision"), rnd("f1").alias("rouge1_f1"))


@query("hallucination_flag", PAIRS_SQL + ", s AS (SELECT conv_id, interaction, len(list_intersect(e, a)) / CAST(len(a) AS DOUBLE) AS x FROM w) SELECT conv_id AS user_id, interaction, round(x, 6) AS support, x < 0.3 AS escalate FROM s")
def hallucination_flag(spark, d):
    out = ev.unsupported(answered(spark, d), "output", "input", 0.3)
    return out.select("user_id", "interaction", rnd("support").alias("support"), "escalate")


# ---- evaluation runs


def eval_runs(spark, d):
    """Conversation turns as test cases; every second answer repeats the question, so its words all occur."""
    pairs = cut_lineage(answered(spark, d)).withColumn("case_id", F.concat_ws("-", text("user_id"), text("interaction")))
    right_tool = F.col("user_id") % 5 != 0
    golden = pairs.select("case_id", F.col("input").alias("expected_output"), F.lit("documentation_search").alias("expected_tool"), F.lit(2000).alias("max_latency_ms"))
    runs = pairs.select(
        "case_id",
        F.when(F.col("interaction") % 2 == 0, F.concat_ws(" ", "input", "output")).otherwise(F.col("output")).alias("actual_output"),
        F.when(right_tool, "Documentation_Search").otherwise("escalate_to_human").alias("actual_tool"),
        F.length("output").cast("double").alias("latency_ms"),
    )
    return ev.score_runs(golden, runs)


EVAL_SQL = PAIRS_SQL + """, z AS (SELECT pr.conv_id || '-' || pr.interaction AS case_id, CASE WHEN pr.interaction % 2 = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(e, a)) / CAST(len(e) AS DOUBLE) END AS accuracy,
 pr.conv_id % 5 <> 0 AS tool_ok, CAST(length(output) AS DOUBLE) AS latency_ms, length(output) <= 2000 AS latency_ok FROM pr JOIN w ON pr.conv_id = w.conv_id AND pr.interaction = w.interaction),
sc AS (SELECT *, CASE WHEN tool_ok AND accuracy > 0.8 AND latency_ok THEN 'pass' WHEN tool_ok OR accuracy > 0.6 THEN 'partial' ELSE 'fail' END AS result, CASE WHEN latency_ok THEN 1.0::DOUBLE ELSE 0.5::DOUBLE END AS latency_score FROM z)
"""


@query("eval_score_run", EVAL_SQL + "SELECT case_id, round(accuracy, 6) AS accuracy, tool_ok, latency_ok, result, latency_score FROM sc")
def eval_score_run(spark, d):
    return eval_runs(spark, d).select("case_id", rnd("accuracy").alias("accuracy"), "tool_ok", "latency_ok", "result", "latency_score")


@query("eval_summary", EVAL_SQL + """SELECT count(*) AS total_tests, count(*) FILTER (WHERE result = 'pass') AS passed, count(*) FILTER (WHERE result = 'partial') AS partial, count(*) FILTER (WHERE result = 'fail') AS failed,
 round(avg(CAST(result = 'pass' AS INT)), 6) AS pass_rate, round(avg(accuracy), 6) AS avg_accuracy, round(avg(latency_ms), 4) AS avg_latency_ms FROM sc""")
def eval_summary(spark, d):
    out = ev.summarise_runs(eval_runs(spark, d))
    return out.withColumn("pass_rate", rnd("pass_rate")).withColumn("avg_accuracy", rnd("avg_accuracy")).withColumn("avg_latency_ms", rnd("avg_latency_ms", 4))


@query("eval_failure_report", EVAL_SQL + """, u AS (SELECT result, unnest(list_filter([CASE WHEN accuracy <= 0.8 THEN 'low accuracy' END, CASE WHEN NOT tool_ok THEN 'wrong tool' END, CASE WHEN NOT latency_ok THEN 'too slow' END], lambda x: x IS NOT NULL)) AS reason FROM sc WHERE result <> 'pass')
SELECT reason, count(*) AS runs, count(*) FILTER (WHERE result = 'fail') AS failed FROM u GROUP BY 1""")
def eval_failure_report(spark, d):
    return ev.failure_reasons(eval_runs(spark, d))


# ---- request logs

REQ = with_("requests")


@query("trace_rollup", REQ + """, sp AS (SELECT user_id || '@' || strftime(ts, '%Y-%m-%d %H') AS trace_id, endpoint, latency_ms FROM requests), st AS (SELECT trace_id, endpoint, count(*) AS spans, sum(latency_ms) AS step_ms FROM sp GROUP BY 1, 2),
t AS (SELECT trace_id, sum(step_ms) AS total_ms FROM st GROUP BY 1)
SELECT st.trace_id, endpoint, spans, round(step_ms, 4) AS step_ms, round(total_ms, 4) AS total_ms, round(step_ms / nullif(total_ms, 0), 6) AS share, total_ms <= 1000 AS within_sla FROM st JOIN t ON st.trace_id = t.trace_id""")
def trace_rollup(spark, d):
    spans = ad.requests(spark, d).withColumn("trace_id", F.concat_ws("@", text("user_id"), F.date_format("ts", "yyyy-MM-dd HH")))
    out = ev.trace_shares(spans, "trace_id", "endpoint", "latency_ms", 1000)
    return out.select("trace_id", "endpoint", "spans", rnd("step_ms", 4).alias("step_ms"), rnd("total_ms", 4).alias("total_ms"), rnd("share").alias("share"), "within_sla")


@query("request_stats", REQ + """, r AS (SELECT instance, latency_ms FROM requests UNION ALL SELECT 'ALL', latency_ms FROM requests), k AS (SELECT *, row_number() OVER (PARTITION BY instance ORDER BY latency_ms) - 1 AS i, count(*) OVER (PARTITION BY instance) AS n FROM r)
SELECT instance, count(*) AS requests, round(avg(latency_ms), 4) AS avg_latency_ms, round(max(latency_ms) FILTER (WHERE i = CAST(floor(n * 0.95::DOUBLE) AS BIGINT)), 4) AS p95 FROM k GROUP BY 1""")
def request_stats(spark, d):
    out = ev.request_stats(ad.requests(spark, d))
    return out.withColumn("avg_latency_ms", rnd("avg_latency_ms", 4)).withColumn("p95", rnd("p95", 4))


TARGETS = {"uptime": (0.999, False), "error_rate": (0.001, True), "requests_per_second": (0.001, False), "cost_per_request": (0.01, True), "p50_ms": (300.0, True), "p95_ms": (500.0, True), "p99_ms": (2000.0, True)}


@query("slo_report", REQ + """, o AS (SELECT 1 - avg(CAST(is_error AS DOUBLE)) AS up, avg(CAST(is_error AS DOUBLE)) AS er, count(*) / ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE) AS rps, avg(tokens_used) * 0.0001::DOUBLE AS cost,
 quantile_cont(latency_ms, 0.5) AS p50, quantile_cont(latency_ms, 0.95) AS p95, quantile_cont(latency_ms, 0.99) AS p99 FROM requests)
SELECT u.metric, round(u.value, 6) AS value, u.target, u.met FROM o, LATERAL (VALUES ('uptime', up, 0.999::DOUBLE, up >= 0.999), ('error_rate', er, 0.001::DOUBLE, er <= 0.001), ('requests_per_second', rps, 0.001::DOUBLE, rps >= 0.001), ('cost_per_request', cost, 0.01::DOUBLE, cost <= 0.01),
 ('p50_ms', p50, 300.0::DOUBLE, p50 <= 300), ('p95_ms', p95, 500.0::DOUBLE, p95 <= 500), ('p99_ms', p99, 2000.0::DOUBLE, p99 <= 2000)) u(metric, value, target, met)""")
def slo_report(spark, d):
    return ev.slo_report(ad.requests(spark, d), TARGETS, 0.0001).withColumn("value", rnd("value"))


@query("scale_signal", REQ + "SELECT instance, round(avg(latency_ms), 4) AS avg_latency_ms, avg(latency_ms) > 500 AS scale_up FROM requests GROUP BY 1")
def scale_signal(spark, d):
    return ev.slow_instances(ad.requests(spark, d), 500).withColumn("avg_latency_ms", rnd("avg_latency_ms", 4))


APP = with_("approvals")


@query("task_stats", APP + "SELECT status, count(*) AS tasks, round(avg((epoch_us(coalesce(decided_at, TIMESTAMP '2001-08-02')) - epoch_us(created_at)) / 1000000.0::DOUBLE), 4) AS mean_seconds FROM approvals GROUP BY 1")
def task_stats(spark, d):
    return ev.task_stats(ad.approvals(spark, d), now()).withColumn("mean_seconds", rnd("mean_seconds", 4))


# ---- approvals

WORTH = "CAST(replace(replace(amount, '$', ''), ',', '') AS DOUBLE)"
ESC = f"CASE WHEN risk_score > 0.8 THEN 'risk' WHEN {WORTH} > 100000 THEN 'amount' END"
STEP = "CASE status WHEN 'approved' THEN 'execute_action' WHEN 'rejected' THEN 'cancel_and_notify' WHEN 'needs_info' THEN 'request_more_info' ELSE 'wait_for_decision' END"


@query("approval_escalate", APP + f"SELECT id, {ESC} AS escalation, {ESC} IS NOT NULL AS is_escalated FROM approvals")
def approval_escalate(spark, d):
    return ev.escalations(ad.approvals(spark, d)).select("id", "escalation", "is_escalated")


@query("approval_route", APP + f"SELECT id, status, {STEP} AS next_step FROM approvals")
def approval_route(spark, d):
    return ad.approvals(spark, d).select("id", "status", ev.next_step(F.col("status")).alias("next_step"))


@query("approval_sla", APP + """, m AS (SELECT *, coalesce(decided_at, TIMESTAMP '2001-08-02') AS ended, (epoch_us(coalesce(decided_at, TIMESTAMP '2001-08-02')) - epoch_us(created_at)) / 60000000.0::DOUBLE AS m FROM approvals)
SELECT id, strftime(created_at + INTERVAL 48 HOUR, '%Y-%m-%d %H:%M') AS sla_deadline, ended > created_at + INTERVAL 48 HOUR AS is_breached,
 CASE WHEN m < 60 THEN CAST(floor(m) AS BIGINT) || 'm' ELSE CAST(floor(m / 60) AS BIGINT) || 'h ' || CAST(floor(m) AS BIGINT) % 60 || 'm' END AS pending_for, status = 'pending' AND TIMESTAMP '2001-08-02' > created_at + INTERVAL 48 HOUR AS is_stale FROM m""")
def approval_sla(spark, d):
    out = ev.sla(ad.approvals(spark, d), now(), 48)
    return out.select("id", F.date_format("sla_deadline", "yyyy-MM-dd HH:mm").alias("sla_deadline"), "is_breached", "pending_for", "is_stale")


@query("approval_metrics", APP + f""", h AS (SELECT *, (epoch_us(decided_at) - epoch_us(created_at)) / 3600000000.0::DOUBLE AS hours FROM approvals)
SELECT count(*) AS requests, round(avg(hours), 4) AS mean_hours, round(quantile_cont(hours, 0.95), 4) AS p95_hours, round(count(*) FILTER (WHERE status = 'approved') / CAST(count(*) FILTER (WHERE status <> 'pending') AS DOUBLE), 6) AS approval_rate,
 round(avg(CAST({ESC} IS NOT NULL AS INT)), 6) AS escalation_rate, round(avg(CAST(status = 'rejected' AND risk_score < 0.5 AS INT)), 6) AS appeal_rate FROM h""")
def approval_metrics(spark, d):
    out = ev.approval_metrics(cut_lineage(ad.approvals(spark, d)))
    return out.select("requests", rnd("mean_hours", 4).alias("mean_hours"), rnd("p95_hours", 4).alias("p95_hours"), *[rnd(c).alias(c) for c in ("approval_rate", "escalation_rate", "appeal_rate")])


@query("approval_audit", APP + f""", t AS (SELECT id, created_at AS made, 'submitted' AS action, amount AS note, 0 AS o FROM approvals UNION ALL SELECT id, created_at, 'escalated', {ESC}, 1 FROM approvals WHERE {ESC} IS NOT NULL
 UNION ALL SELECT id, decided_at, status, {STEP}, 2 FROM approvals WHERE status <> 'pending')
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY o) - 1 AS INT) AS step, strftime(made, '%Y-%m-%d') AS day, action, note FROM t""")
def approval_audit(spark, d):
    return ev.audit_trail(ad.approvals(spark, d)).select("id", "step", F.date_format("at", "yyyy-MM-dd").alias("day"), "action", "note")


@query("expense_policy_check", APP + f""", e AS (SELECT id, {WORTH} AS w, risk_score, concat_ws('|', CASE WHEN {WORTH} > 300000 THEN 'over limit' END, CASE WHEN dayofweek(created_at) IN (0, 6) THEN 'weekend' END) AS policy_errors FROM approvals)
SELECT id, policy_errors, CASE WHEN w > 400000 OR risk_score > 0.7 THEN 'director' WHEN policy_errors <> '' THEN 'manager' ELSE 'payment' END AS desk FROM e""")
def expense_policy_check(spark, d):
    out = ev.expense_decisions(ad.approvals(spark, d), 300_000, 400_000, 0.7)
    return out.select("id", joined("policy_errors").alias("policy_errors"), "desk")


@query("consensus_vote", """SELECT l_partkey AS proposal, count(*) AS votes, count(*) FILTER (WHERE l_returnflag = 'A') AS agree, count(*) FILTER (WHERE l_returnflag = 'R') AS objections,
 CASE WHEN count(*) FILTER (WHERE l_returnflag = 'A') * 2 > count(*) THEN 'consensus' ELSE 'escalate' END AS outcome FROM lineitem GROUP BY 1""")
def consensus_vote(spark, d):
    votes = src.table(spark, d, "lineitem").select(F.col("l_partkey").alias("proposal"), "l_returnflag")
    return ev.consensus(votes, "proposal", "l_returnflag", "A", "R")


@query("region_sales_rank", with_("subs") + """, c AS (SELECT region, date_trunc('quarter', o_orderdate) AS q, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS r, count(*) AS deals FROM orders JOIN subs ON o_custkey = user_id GROUP BY 1, 2),
g AS (SELECT *, CAST(r AS DOUBLE) / CAST(lag(r) OVER (PARTITION BY region ORDER BY q) AS DOUBLE) - 1 AS growth FROM c),
o AS (SELECT region, CAST(sum(r) AS DOUBLE) AS revenue, CAST(sum(deals) AS BIGINT) AS deals, avg(growth) AS mg, count(*) FILTER (WHERE abs(growth) > 0.5) AS unusual_quarters FROM g GROUP BY 1)
SELECT region, round(revenue, 2) AS revenue, deals, round(mg, 6) AS mean_growth, unusual_quarters, round(revenue / deals, 4) AS avg_deal, CAST(dense_rank() OVER (ORDER BY revenue DESC) AS INT) AS rank, dense_rank() OVER (ORDER BY revenue DESC) <= 3 AS is_top FROM o""")
def region_sales_rank(spark, d):
    users = src.table(spark, d, "customer").join(ad.regions(spark, d), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("o_custkey"), "region")
    sales = src.table(spark, d, "orders").select("o_custkey", "o_totalprice", F.date_trunc("quarter", "o_orderdate").alias("quarter")).join(users, "o_custkey")
    out = ev.region_ranking(sales, "region", "quarter", "o_totalprice")
    return out.select("region", rnd("revenue", 2).alias("revenue"), "deals", rnd("mean_growth").alias("mean_growth"), "unusual_quarters", rnd("avg_deal", 4).alias("avg_deal"), "rank", (F.col("rank") <= 3).alias("is_top"))


@query("readability", """WITH s AS (SELECT doc_id, CAST(len(list_filter(regexp_split_to_array(text, '[.!?]+'), lambda x: trim(regexp_replace(x, '\\s+', ' ', 'g')) <> '')) AS INT) AS sentences,
 CAST(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS INT) AS words FROM documents)
SELECT doc_id, sentences, words, round(words / CAST(nullif(sentences, 0) AS DOUBLE), 6) AS words_per_sentence, round(words / 200.0::DOUBLE, 6) AS read_minutes FROM s""")
def readability(spark, d):
    out = ev.readability(docs(spark, d).select("doc_id", "text"))
    return out.select("doc_id", "sentences", "words", rnd("words_per_sentence").alias("words_per_sentence"), rnd("read_minutes").alias("read_minutes"))


@query("keyword_density", """WITH k AS (SELECT page_id, CAST(len(regexp_extract_all(lower(html), '\\b(the|der|los|les)\\b')) AS INT) AS keyword_count, CAST(len(regexp_extract_all(html, '<h[1-6]')) AS INT) AS headers,
 CAST(len(list_filter(regexp_split_to_array(html, '\\s+'), lambda x: x <> '')) AS INT) AS words FROM (SELECT page_id, regexp_replace(html, '[^\\x00-\\x7F]', '0', 'g') AS html FROM pages))
SELECT page_id, keyword_count, headers, words, round(keyword_count / CAST(words AS DOUBLE), 8) AS density FROM k""")
def keyword_density(spark, d):
    pages = src.table(spark, d, "pages").select("page_id", "html")
    out = pages.select(
        "page_id", F.regexp_count(F.lower("html"), F.lit(r"(?U)\b(the|der|los|les)\b")).alias("keyword_count"), F.regexp_count("html", F.lit("<h[1-6]")).alias("headers"),
        F.size(F.filter(F.split("html", r"\s+"), lambda w: w != "")).alias("words"),
    )
    return out.withColumn("density", rnd(F.try_divide("keyword_count", "words"), 8))
