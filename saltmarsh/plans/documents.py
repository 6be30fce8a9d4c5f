"""Text, document, ticket and catalog functions (inventory 2.8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scale import micros
from ..operators import textops as tx
from ..sources import adapters as ad
from ..sources import tables as src
from .oracle import with_
from .registry import query, rnd, text

KIND_SQL = "CASE WHEN contains(lower(text), 'buy now') THEN 'spam' WHEN contains(lower(text), 'hate') THEN 'toxic' ELSE 'clean' END"
POSTS_SQL = with_("tickets") + ", posts AS (SELECT 'doc-' || doc_id AS content_id, text FROM documents UNION ALL SELECT 'mail-' || ticket_id, text FROM tickets)\n"


def posts(spark, d):
    """Everything users wrote: documents and mails."""
    docs = src.table(spark, d, "documents").select(F.concat(F.lit("doc-"), text("doc_id")).alias("content_id"), "text")
    mails = ad.tickets(spark, d).select(F.concat(F.lit("mail-"), text("ticket_id")).alias("content_id"), "text")
    return docs.unionByName(mails)


def joined(c, sep="|"):
    return F.array_join(c, sep)


@query("classify_content", POSTS_SQL + f"SELECT content_id, {KIND_SQL} AS content_type FROM posts")
def classify_content(spark, d):
    return posts(spark, d).select("content_id", tx.content_type(F.col("text")).alias("content_type"))


@query("moderation_route", POSTS_SQL + f""", k AS (SELECT content_id, {KIND_SQL} AS content_type FROM posts)
SELECT content_id, content_type, CASE content_type WHEN 'spam' THEN 'rejected' WHEN 'toxic' THEN 'needs_review' ELSE 'approved' END AS decision,
 CASE content_type WHEN 'spam' THEN 'Spam detected - auto-rejected' WHEN 'toxic' THEN 'Toxic content - queued for human review' ELSE 'Clean content - approved for publication' END AS summary FROM k""")
def moderation_route(spark, d):
    return tx.moderate(posts(spark, d)).drop("text")


LEVEL_SQL = """WITH l AS (SELECT d.doc_id, lower(text) AS t, toxic FROM documents d LEFT JOIN labels b ON d.doc_id = b.doc_id),
m AS (SELECT doc_id, toxic, CASE WHEN regexp_matches(t, 'i hate you|disgusting') THEN 'severe' WHEN regexp_matches(t, 'hate|worthless|trash') THEN 'toxic' WHEN regexp_matches(t, 'stupid|annoying|clown') THEN 'mild' ELSE 'clean' END AS level,
 concat_ws('|', CASE WHEN contains(t, 'hate') THEN 'hate_speech' END, CASE WHEN regexp_matches(t, 'stupid|worthless|clown|trash|disgusting') THEN 'harassment' END,
 CASE WHEN regexp_matches(t, 'buy now|click here|% off') THEN 'promotion' END) AS violations FROM l),
r AS (SELECT *, CASE level WHEN 'severe' THEN 'reject' WHEN 'toxic' THEN 'review' WHEN 'mild' THEN 'warn' ELSE 'approve' END AS decision FROM m)
"""


def judged(spark, d):
    docs = tx.moderate_levels(src.table(spark, d, "documents").select("doc_id", "text")).drop("text")
    return docs.join(src.table(spark, d, "labels").select("doc_id", "toxic"), "doc_id", "left")


@query("moderation_levels", LEVEL_SQL + "SELECT doc_id, level, decision, violations FROM r")
def moderation_levels(spark, d):
    return judged(spark, d).select("doc_id", "level", "decision", joined("violations").alias("violations"))


@query("moderation_rates", LEVEL_SQL + """SELECT count(*) AS texts, round(avg(CAST(decision = 'approve' AS INT)), 6) AS approval_rate, count(*) FILTER (WHERE decision <> 'approve' AND toxic = 0) AS false_positives,
 round(count(*) FILTER (WHERE decision <> 'approve' AND toxic = 0) / CAST(count(*) FILTER (WHERE toxic = 0) AS DOUBLE), 6) AS false_positive_rate FROM r""")
def moderation_rates(spark, d):
    flagged, safe = F.col("decision") != "approve", F.col("toxic") == 0
    return judged(spark, d).agg(
        F.count("*").alias("texts"), rnd(F.avg((~flagged).cast("int"))).alias("approval_rate"),
        F.count_if(flagged & safe).alias("false_positives"), rnd(F.try_divide(F.count_if(flagged & safe), F.count_if(safe))).alias("false_positive_rate"),
    )


DOCS = with_("docs")


def papers(spark, d):
    return ad.paperwork(spark, d)


@query("classify_document", DOCS + "SELECT document_id, document_type, confidence FROM docs")
def classify_document(spark, d):
    return tx.classify(papers(spark, d)).select("document_id", "document_type", "confidence")


@query("classify_document_simple", with_("papers") + "SELECT document_id, CASE WHEN regexp_matches(lower(text), 'invoice|payment') THEN 'invoice' WHEN regexp_matches(lower(text), 'agreement|contract') THEN 'contract' ELSE 'report' END AS doc_type FROM papers")
def classify_document_simple(spark, d):
    return papers(spark, d).select("document_id", tx.first_match(F.col("text"), tx.SIMPLE_KEYWORDS, "report").alias("doc_type"))


@query("validate_text", "SELECT doc_id, CASE WHEN coalesce(length(text), 0) = 0 THEN 'Empty document' WHEN length(text) < 10 THEN 'Document too short' ELSE '' END AS error FROM documents")
def validate_text(spark, d):
    return src.table(spark, d, "documents").select("doc_id", tx.text_error(F.col("text")).alias("error"))


def language_sql():
    hits = ", ".join(
        f"len(list_filter(w, lambda x: list_contains([{', '.join(repr(s) for s in stops)}], x))) AS {code}" for code, stops in tx.STOP_WORDS.items()
    )
    return f"""WITH t AS (SELECT doc_id, lang, regexp_split_to_array(lower(text), '\\s+') AS w FROM documents), h AS (SELECT doc_id, lang, {hits} FROM t)
SELECT doc_id, lang, CASE WHEN greatest(de, en, es, fr) = 0 THEN 'unknown' WHEN de = greatest(de, en, es, fr) THEN 'de' WHEN en = greatest(de, en, es, fr) THEN 'en' WHEN es = greatest(de, en, es, fr) THEN 'es' ELSE 'fr' END AS detected FROM h"""


@query("detect_language", language_sql())
def detect_language(spark, d):
    return tx.with_language(src.table(spark, d, "documents").select("doc_id", "lang", "text")).drop("text")


@query("extract_dates", DOCS + "SELECT document_id, array_to_string(dates, '|') AS dates FROM docs WHERE len(dates) > 0")
def extract_dates(spark, d):
    out = papers(spark, d).select("document_id", tx.dates(F.col("text")).alias("dates"))
    return out.where(F.size("dates") > 0).select("document_id", joined("dates").alias("dates"))


@query("extract_amounts", DOCS + "SELECT document_id, CAST(len(amounts) AS INT) AS n, amounts[1] AS first_amount, round(list_sum(amounts), 4) AS total FROM docs WHERE len(amounts) > 0")
def extract_amounts(spark, d):
    out = papers(spark, d).select("document_id", tx.amounts(F.col("text")).alias("a")).where(F.size("a") > 0)
    total = F.aggregate("a", F.lit(0.0), lambda acc, x: acc + x)
    return out.select("document_id", F.size("a").alias("n"), F.get("a", 0).alias("first_amount"), rnd(total, 4).alias("total"))


@query("extract_parties", DOCS + "SELECT document_id, array_to_string(parties, '|') AS parties FROM docs")
def extract_parties(spark, d):
    return tx.extract(papers(spark, d)).select("document_id", joined("parties").alias("parties"))


@query("build_entities", DOCS + "SELECT document_id, array_to_string(entities, '|') AS entities FROM docs")
def build_entities(spark, d):
    pairs = F.transform("entities", lambda e: F.concat(e["type"], F.lit("="), e["value"]))
    return tx.extract(papers(spark, d)).select("document_id", joined(pairs).alias("entities"))


@query("validate_extraction", DOCS + "SELECT document_id, document_type, is_valid, array_to_string(errors, '|') AS validation_errors FROM docs")
def validate_extraction(spark, d):
    out = tx.validate(tx.extract(tx.classify(papers(spark, d))))
    return out.select("document_id", "document_type", "is_valid", joined("validation_errors").alias("validation_errors"))


@query("summarize_document", DOCS + """SELECT document_id, summary, CASE document_type WHEN 'invoice' THEN 'Amount due: $' || coalesce(money, 'unknown') || '|Date: ' || coalesce(dates[1], 'unknown') || '|Entities extracted: ' || len(entities)
 WHEN 'contract' THEN 'Parties: ' || array_to_string(parties[1:3], ', ') || '|Dates mentioned: ' || len(dates) ELSE 'Type: ' || document_type || '|Language: en' END AS key_points FROM docs""")
def summarize_document(spark, d):
    return tx.process_documents(papers(spark, d)).select("document_id", "summary", joined("key_points").alias("key_points"))


@query("route_document", DOCS + "SELECT document_id, routing_decision, priority FROM docs")
def route_document(spark, d):
    return tx.process_documents(papers(spark, d)).select("document_id", "routing_decision", "priority")


@query("route_by_value", "SELECT event_id, CASE WHEN value < 50 THEN 'low' ELSE 'high' END AS route FROM events")
def route_by_value(spark, d, limit: float = 50):
    return src.table(spark, d, "events").select("event_id", F.when(F.col("value") < limit, "low").otherwise("high").alias("route"))


@query("doc_pipeline", DOCS + """SELECT document_id, document_type, confidence, CAST(len(dates) AS INT) AS dates, CAST(len(amounts) AS INT) AS amounts, is_valid, summary, routing_decision, priority FROM docs""")
def doc_pipeline(spark, d):
    return tx.process_documents(papers(spark, d)).select(
        "document_id", "document_type", "confidence", F.size("dates").alias("dates"), F.size("amounts").alias("amounts"), "is_valid", "summary", "routing_decision", "priority"
    )


@query("invalid_skip_summary", DOCS + "SELECT document_id, is_valid, CASE WHEN is_valid THEN summary END AS summary FROM docs")
def invalid_skip_summary(spark, d):
    return tx.process_documents(papers(spark, d)).select("document_id", "is_valid", F.when(F.col("is_valid"), F.col("summary")).alias("summary"))


@query("error_quarantine", DOCS + """, e AS (SELECT document_id, concat_ws('|', CASE WHEN length(text) < 10 THEN 'Document too short' END, nullif(array_to_string(errors, '|'), '')) AS errors FROM docs)
SELECT document_id, errors FROM e WHERE errors <> ''""")
def error_quarantine(spark, d):
    out = tx.validate(tx.extract(tx.classify(papers(spark, d))))
    short = F.nullif(tx.text_error(F.col("text")), F.lit(""))
    errors = F.filter(F.concat(F.array(short), F.col("validation_errors")), lambda e: e.isNotNull())
    # a generator keeps the failing rows without evaluating the rules again in a filter
    return out.select("document_id", F.explode(F.filter(F.array(joined(errors)), lambda e: e != "")).alias("errors"))


# ---- tickets, mails, rendered prompts


@query("ticket_fields", with_("tickets") + """SELECT ticket_id, nullif(regexp_extract(text, '(ERR_[A-Z0-9_]+)', 1), '') AS error_code, nullif(regexp_extract(text, '(?i)\\b(export|dashboard|login|invoice|dark mode)\\b', 1), '') AS affected_feature,
 nullif(regexp_extract(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', 0), '') AS email FROM tickets""")
def ticket_fields(spark, d):
    return tx.ticket_fields(ad.tickets(spark, d)).select("ticket_id", "error_code", "affected_feature", "email")


@query("ticket_steps", with_("tickets") + ", s AS (SELECT ticket_id, regexp_extract_all(text, '(?m)^\\s*[0-9]+\\.\\s*(.+)$', 1) AS s FROM tickets) SELECT ticket_id, CAST(len(s) AS INT) AS n, array_to_string(s, '|') AS steps FROM s WHERE len(s) > 0")
def ticket_steps(spark, d):
    out = tx.ticket_fields(ad.tickets(spark, d)).where(F.size("steps") > 0)
    return out.select("ticket_id", F.size("steps").alias("n"), joined("steps").alias("steps"))


TRIAGE_SQL = with_("tickets") + """, c AS (SELECT ticket_id, lower(text) AS t, CASE WHEN regexp_matches(lower(text), 'fails|error|not working|timeout') THEN 'bug' WHEN regexp_matches(lower(text), 'invoice|billing|refund') THEN 'billing'
 WHEN regexp_matches(lower(text), 'feature request|please add') THEN 'feature_request' ELSE 'question' END AS category FROM tickets),
p AS (SELECT *, CAST(least(CASE category WHEN 'bug' THEN 3 WHEN 'billing' THEN 2 ELSE 1 END + CASE WHEN regexp_matches(t, 'urgent|asap|emergency|blocking') THEN 2 ELSE 0 END, 5) AS INT) AS priority FROM c)
"""


@query("ticket_rules_triage", TRIAGE_SQL + """SELECT ticket_id, category, priority, CASE category WHEN 'bug' THEN 'engineering' WHEN 'billing' THEN 'billing' WHEN 'feature_request' THEN 'product' ELSE 'support' END AS team,
 priority >= 4 AS escalate, CASE WHEN priority >= 4 THEN 'HIGH' ELSE 'MEDIUM' END AS priority_label FROM p""")
def ticket_rules_triage(spark, d):
    return tx.triage(ad.tickets(spark, d)).select("ticket_id", "category", "priority", "team", "escalate", "priority_label")


@query("email_triage", with_("tickets") + """SELECT ticket_id, CASE WHEN regexp_matches(lower(text), 'buy now|% off|click here') THEN 'spam' WHEN regexp_matches(lower(text), 'urgent|asap|by tonight|by tomorrow') THEN 'urgent'
 WHEN regexp_matches(lower(text), '\\?|let me know') THEN 'follow_up' ELSE 'normal' END AS category, array_to_string(regexp_extract_all(text, '(?i)\\bby ([0-9]{1,2}(?:am|pm)|tonight|tomorrow)\\b', 1), '|') AS deadlines FROM tickets""")
def email_triage(spark, d):
    return tx.triage_mail(ad.tickets(spark, d)).select("ticket_id", "category", joined("deadlines").alias("deadlines"))


REPLY = """CASE WHEN event_type = 'view' THEN '{"category": "question", "priority": ' ELSE '{"category": "' || CASE event_type WHEN 'error' THEN 'bug' WHEN 'purchase' THEN 'billing' WHEN 'click' THEN 'feature_request' ELSE 'nonsense' END
 || '", "priority": ' || CAST(floor(value / 70) AS INT) || ', "sentiment": "neutral"}' END"""


@query("llm_json_parse", f"""WITH r AS (SELECT event_id, {REPLY} AS raw FROM events), p AS (SELECT event_id, CASE WHEN json_valid(raw) THEN raw END AS j FROM r),
f AS (SELECT event_id, json_extract_string(j, '$.category') AS category, CAST(json_extract_string(j, '$.priority') AS INT) AS priority, json_extract_string(j, '$.sentiment') AS sentiment FROM p)
SELECT *, concat_ws('|', CASE WHEN category IS NULL THEN 'unreadable' END, CASE WHEN category NOT IN ('bug', 'feature_request', 'question', 'billing', 'urgent') THEN 'bad category' END,
 CASE WHEN priority NOT BETWEEN 1 AND 5 THEN 'bad priority' END) AS errors FROM f""")
def llm_json_parse(spark, d):
    kind = F.col("event_type")
    name = tx.lookup(kind, {"error": "bug", "purchase": "billing", "click": "feature_request", "signup": "nonsense"})
    whole = F.concat(F.lit('{"category": "'), name, F.lit('", "priority": '), text(F.floor(F.col("value") / 70)), F.lit(', "sentiment": "neutral"}'))
    raw = F.when(kind == "view", F.lit('{"category": "question", "priority": ')).otherwise(whole)
    replies = src.table(spark, d, "events").select("event_id", raw.alias("raw"))
    return tx.parse_reply(replies, "raw").select("event_id", "category", "priority", "sentiment", joined("errors").alias("errors"))


PROMPT = "Plan {plan} in {region}: user {user} left on {left} after {days} days."


@query("prompt_render", with_("subs") + """SELECT user_id, 'Plan ' || plan_tier || ' in ' || region || ': user ' || user_id || ' left on ' || CAST(churn_date AS VARCHAR) || ' after ' || tenure_days || ' days.' AS prompt,
 concat_ws('|', CASE WHEN churn_date IS NULL THEN 'left' END, CASE WHEN tenure_days IS NULL THEN 'days' END) AS errors FROM subs""")
def prompt_render(spark, d):
    slots = {"plan": F.col("plan_tier"), "region": F.col("region"), "user": F.col("user_id"), "left": F.col("churn_date"), "days": F.col("tenure_days")}
    filled, empty = tx.render(PROMPT, slots)
    return ad.subscriptions(spark, d).select("user_id", filled.alias("prompt"), joined(empty).alias("errors"))


@query("chat_messages_render", """SELECT conv_id, turn, CAST(4 AS INT) AS messages, md5(concat_ws(chr(10), 'system:You answer support questions.', 'human:How do I export?', 'ai:Open reports and click export.', 'human:' || text)) AS digest
FROM conversations WHERE role = 'user'""")
def chat_messages_render(spark, d):
    shots = [("system", "You answer support questions."), ("human", "How do I export?"), ("ai", "Open reports and click export.")]
    asked = ad.conversations(spark, d).where(F.col("role") == "user")
    chat = tx.chat(shots, F.col("text"))
    lines = F.transform("m", lambda m: F.concat(m["role"], F.lit(":"), m["content"]))
    return asked.withColumn("m", chat).select("conv_id", "turn", F.size("m").alias("messages"), F.md5(F.array_join(lines, "\n")).alias("digest"))


# the oracle engine's word boundary is ASCII, so letters beyond it are fenced with zeros for the name step
@query("pii_redact", POSTS_SQL + """, r AS (SELECT content_id, regexp_replace(regexp_replace(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}', '[EMAIL]', 'g'), '[0-9](?:[ -]?[0-9]){12,15}', '[CARD]', 'g') AS t FROM posts),
n AS (SELECT content_id, regexp_replace(regexp_replace(t, '([^\\x00-\\x7F])', '0\\10', 'g'), '\\b[A-Z][a-z]+ [A-Z][a-z]+\\b', '[NAME]', 'g') AS t FROM r)
SELECT content_id, md5(regexp_replace(t, '0([^\\x00-\\x7F])0', '\\1', 'g')) AS digest FROM n""")
def pii_redact(spark, d):
    return posts(spark, d).select("content_id", F.md5(tx.redact(F.col("text"))).alias("digest"))


@query("retention_purge", "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-31' - INTERVAL 15 DAY AND user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def retention_purge(spark, d):
    events = src.table(spark, d, "events").where(F.col("ts") >= F.lit("2024-01-31").cast("timestamp_ntz") - F.expr("INTERVAL 15 DAYS"))
    erased = src.table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    return events.join(erased, "user_id", "left_anti").select("event_id", "user_id")


# ---- nested catalog, carts, money


def nested_catalog(spark, d):
    """Category rows holding product arrays, at most a thousand products to a row."""
    product = F.struct(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"),
        F.array(F.element_at(F.split("p_name", " "), 1)).alias("colors"), F.array(F.col("p_size"), F.col("p_size") + 1).alias("sizes"),
    )
    parts = src.table(spark, d, "part").withColumn("page", F.floor(F.col("p_partkey") / 1000))
    return parts.groupBy(F.col("p_type").alias("category"), "page").agg(F.collect_list(product).alias("products"))


@query("catalog_explode", """SELECT p_type AS category, p_partkey AS id, p_name AS name, p_retailprice AS price FROM part WHERE p_retailprice <= 1500 AND split_part(p_name, ' ', 1) = 'red' AND (p_size = 10 OR p_size + 1 = 10)""")
def catalog_explode(spark, d):
    rows = nested_catalog(spark, d).select("category", F.inline("products"))
    keep = (F.col("price") <= 1500) & F.array_contains("colors", "red") & F.array_contains("sizes", 10)
    return rows.where(keep).select("category", "id", "name", "price")


COLOURS = {"BUILDING": "red", "AUTOMOBILE": "blue", "MACHINERY": "small", "HOUSEHOLD": "large", "FURNITURE": "green"}


def colour_sql():
    return "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in COLOURS.items()) + " END"


@query("preference_product_match", f"""WITH u AS (SELECT c_custkey AS user_id, {colour_sql()} AS colour, 900 + abs(c_acctbal) / 50 AS budget FROM customer), p AS (SELECT p_partkey AS id, split_part(p_name, ' ', 1) AS colour, p_retailprice AS price FROM part)
SELECT user_id, u.colour, round(budget, 4) AS budget, count(p.id) AS matches, max(price) AS best_price FROM u LEFT JOIN p ON u.colour = p.colour AND p.price <= u.budget WHERE u.colour IS NOT NULL GROUP BY 1, 2, budget""")
def preference_product_match(spark, d):
    users = src.table(spark, d, "customer").select(
        F.col("c_custkey").alias("user_id"), tx.lookup(F.col("c_mktsegment"), COLOURS).alias("colour"), (900 + F.abs("c_acctbal") / 50).alias("budget")
    ).where(F.col("colour").isNotNull())
    products = src.table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.element_at(F.split("p_name", " "), 1).alias("colour"), F.col("p_retailprice").alias("price"))
    out = tx.rank_within_budget(products, users, F.floor(F.col("at")))
    return out.select("user_id", "colour", rnd("budget", 4).alias("budget"), "matches", "best_price")


@query("cart_total", "SELECT l_orderkey AS cart_id, count(*) AS items, round(sum(l_extendedprice), 2) AS total, sum(CAST(l_extendedprice AS DECIMAL(18,2))) > 100000 AS free_shipping FROM lineitem GROUP BY 1")
def cart_total(spark, d, free_above: float = 100_000):
    exact = F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))
    out = src.table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("cart_id")).agg(F.count("*").alias("items"), exact.alias("t"))
    return out.select("cart_id", "items", rnd(F.col("t").cast("double"), 2).alias("total"), (F.col("t") > free_above).alias("free_shipping"))


@query("parse_money", "SELECT o_orderkey AS id, o_totalprice AS amount FROM orders")
def parse_money(spark, d):
    return ad.approvals(spark, d).select("id", tx.parse_money(F.col("amount")).alias("amount"))


@query("format_pending", """WITH m AS (SELECT id, (epoch_us(decided_at) - epoch_us(created_at)) / 60000000.0::DOUBLE AS m FROM (SELECT event_id AS id, ts AS decided_at, date_trunc('day', ts) AS created_at FROM events))
SELECT id, CASE WHEN m < 60 THEN CAST(floor(m) AS BIGINT) || 'm' ELSE CAST(floor(m / 60) AS BIGINT) || 'h ' || CAST(floor(m) AS BIGINT) % 60 || 'm' END AS pending FROM m""")
def format_pending(spark, d):
    waited = (micros("ts") - micros(F.to_date("ts").cast("timestamp_ntz"))) / 60_000_000
    return src.table(spark, d, "events").select(F.col("event_id").alias("id"), tx.pending_text(waited).alias("pending"))


@query("unit_normalize", """WITH n AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings), s AS (SELECT vec_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS norm FROM n)
SELECT vec_id, round(norm, 6) AS norm, round(v[1] / norm, 6) AS first, round(v[64] / norm, 6) AS last FROM s""")
def unit_normalize(spark, d):
    vec = src.table(spark, d, "embeddings").withColumn("u", tx.unit(F.col("embedding")))
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return vec.select("vec_id", rnd(norm).alias("norm"), rnd(F.get("u", 0)).alias("first"), rnd(F.element_at("u", -1)).alias("last"))


@query("days_since", "SELECT event_id, date_diff('day', CAST(ts AS DATE), DATE '2024-01-31') AS days FROM events")
def days_since(spark, d):
    days = F.datediff(ad.day(ad.EVENTS_AS_OF), F.to_date("ts")).cast("bigint")
    return src.table(spark, d, "events").select("event_id", days.alias("days"))
