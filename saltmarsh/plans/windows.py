"""Windows, histories, checkpoints and set operations (inventory 2.5 and 2.7)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scale import newest, quantile_scalars
from ..operators import clean, sessions as ses, windows as win
from ..operators.textops import first_distinct, overlap, parties
from ..session import cut_lineage
from ..sources import adapters as ad
from ..sources import tables as src
from .aggregates import DAU_SQL, daily_users, month
from .oracle import with_
from .registry import query, rnd, text
from .tables import SESSION_SQL, profile, today

GRID_SQL = DAU_SQL + ", b AS (SELECT region, avg(users) AS m, stddev_pop(users) AS s FROM dau GROUP BY 1)\n"


def grid(spark, d):
    return win.against_group(cut_lineage(daily_users(spark, d)), "region", "users")


@query("baseline_ratio", GRID_SQL + "SELECT CAST(day AS VARCHAR) AS day, d.region, users, round(users / m, 6) AS ratio FROM dau d JOIN b ON d.region = b.region")
def baseline_ratio(spark, d):
    return grid(spark, d).select(text("day").alias("day"), "region", "users", rnd("ratio").alias("ratio"))


@query("region_deviation", GRID_SQL + "SELECT CAST(day AS VARCHAR) AS day, d.region, round(users - m, 6) AS deviation FROM dau d JOIN b ON d.region = b.region")
def region_deviation(spark, d):
    return grid(spark, d).select(text("day").alias("day"), "region", rnd("deviation").alias("deviation"))


@query("region_growth", DAU_SQL + """, g AS (SELECT day, region, users, lag(users) OVER (PARTITION BY region ORDER BY day) AS prev FROM dau)
SELECT CAST(day AS VARCHAR) AS day, region, users, prev AS prev_users, round(users / CAST(prev AS DOUBLE) - 1, 6) AS growth FROM g WHERE prev IS NOT NULL ORDER BY users / CAST(prev AS DOUBLE) DESC, day DESC, region LIMIT 1""")
def region_growth(spark, d):
    g = win.growth(daily_users(spark, d), "region", "day", "users").where(F.col("growth").isNotNull())
    best = g.orderBy(F.col("growth").desc(), F.col("day").desc(), "region").limit(1)
    return best.select(text("day").alias("day"), "region", "users", "prev_users", rnd("growth").alias("growth"))


@query("region_zscore_anomaly", GRID_SQL + "SELECT CAST(day AS VARCHAR) AS day, d.region, users, round((users - m) / s, 6) AS z FROM dau d JOIN b ON d.region = b.region WHERE abs((users - m) / s) > 2")
def region_zscore_anomaly(spark, d):
    return grid(spark, d).where(F.abs("z") > 2).select(text("day").alias("day"), "region", "users", rnd("z").alias("z"))


def retention_sql(days):
    cols = ", ".join(
        f"CASE WHEN date_diff('day', last_day(signup_month), DATE '2001-08-02') >= {n} THEN round(avg(CAST(tenure_days >= {n} AS INT)), 6) END AS d{n}" for n in days
    )
    return with_("subs") + f", c AS (SELECT *, CAST(date_trunc('month', signup_date) AS DATE) AS signup_month FROM subs)\nSELECT CAST(signup_month AS VARCHAR) AS signup_month, count(*) AS users, {cols} FROM c GROUP BY c.signup_month"


def retention(spark, d, days):
    df = clean.lifetime_days(ad.subscriptions(spark, d), today())
    out = win.retention(df, today(), days)
    return out.select(text("signup_month").alias("signup_month"), "users", *[rnd(f"d{n}").alias(f"d{n}") for n in days])


@query("retention_30_60_90", retention_sql([30, 60, 90]))
def retention_30_60_90(spark, d):
    return retention(spark, d, [30, 60, 90])


MATRIX_DAYS = [90, 180, 365, 730, 1095, 1460, 1825]


@query("retention_matrix", retention_sql(MATRIX_DAYS))
def retention_matrix(spark, d):
    return retention(spark, d, MATRIX_DAYS)


@query("cumulative_adoption", with_("usage", "subs") + """, f AS (SELECT user_id, feature_name, min(date) AS first_use FROM usage GROUP BY 1, 2),
n AS (SELECT s.plan_tier, CAST(floor(date_diff('day', s.signup_date, f.first_use) / 90.0::DOUBLE) AS BIGINT) AS step, count(*) AS new_uses FROM f JOIN subs s ON f.user_id = s.user_id GROUP BY 1, 2)
SELECT plan_tier, step, new_uses, CAST(sum(new_uses) OVER (PARTITION BY plan_tier ORDER BY step) AS BIGINT) AS cumulative_uses FROM n""")
def cumulative_adoption(spark, d):
    return win.cumulative_first_uses(ad.feature_usage(spark, d), ad.subscriptions(spark, d), "plan_tier")


@query("engagement_velocity", with_("usage") + """, a AS (SELECT user_id, date_diff('day', date, DATE '2001-08-02') AS age, usage_count AS v FROM usage),
g AS (SELECT user_id, coalesce(sum(v) FILTER (WHERE age >= 0 AND age < 30), 0.0::DOUBLE) AS recent, coalesce(sum(v) FILTER (WHERE age >= 30 AND age < 60), 0.0::DOUBLE) AS before FROM a GROUP BY 1)
SELECT user_id, recent, before, recent - before AS velocity FROM g""")
def engagement_velocity(spark, d):
    return win.velocity(ad.feature_usage(spark, d), today())


@query("declining_trend", with_("usage") + """, a AS (SELECT user_id, date_diff('day', date, DATE '2001-08-02') < 180 AS recent, usage_count AS v FROM usage),
g AS (SELECT user_id, avg(v) FILTER (WHERE recent) AS r, avg(v) FILTER (WHERE NOT recent) AS h FROM a GROUP BY 1)
SELECT user_id, round(r, 6) AS recent_avg, round(h, 6) AS history_avg, round(r / h, 6) AS ratio FROM g WHERE r / h < 1""")
def declining_trend(spark, d):
    out = win.recent_vs_history(ad.feature_usage(spark, d), today(), 180).where("is_declining")
    return out.select("user_id", rnd("recent_avg").alias("recent_avg"), rnd("history_avg").alias("history_avg"), rnd("ratio").alias("ratio"))


@query("conversion_funnel", """WITH f AS (SELECT user_id, min(ts) FILTER (WHERE event_type = 'signup') AS t0, min(ts) FILTER (WHERE event_type = 'view') AS t1,
 min(ts) FILTER (WHERE event_type = 'click') AS t2, min(ts) FILTER (WHERE event_type = 'purchase') AS t3 FROM events GROUP BY 1),
c AS (SELECT count(*) FILTER (WHERE t0 IS NOT NULL) n0, count(*) FILTER (WHERE t1 >= t0) n1, count(*) FILTER (WHERE t1 >= t0 AND t2 >= t1) n2, count(*) FILTER (WHERE t1 >= t0 AND t2 >= t1 AND t3 >= t2) n3 FROM f)
SELECT CAST(i AS INT) AS step_no, s AS step, n AS users, round(n / CAST(p AS DOUBLE), 6) AS step_rate, round(n / CAST(n0 AS DOUBLE), 6) AS total_rate FROM c,
 LATERAL (VALUES (1, 'signup', n0, n0), (2, 'view', n1, n0), (3, 'click', n2, n1), (4, 'purchase', n3, n2)) u(i, s, n, p)""")
def conversion_funnel(spark, d):
    out = win.funnel(ad.user_events(spark, d), ["signup", "view", "click", "purchase"])
    return out.withColumn("step_rate", rnd("step_rate")).withColumn("total_rate", rnd("total_rate"))


@query("session_duration", """WITH l AS (SELECT user_id, event_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
m AS (SELECT user_id, ts, sum(CASE WHEN prev IS NULL OR epoch_us(ts) - epoch_us(prev) > 21600000000 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS session_no FROM l),
s AS (SELECT user_id, session_no, count(*) AS events, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0::DOUBLE AS seconds FROM m GROUP BY 1, 2)
SELECT count(*) AS sessions, CAST(sum(events) AS BIGINT) AS events, round(avg(seconds), 4) AS mean_seconds, round(quantile_cont(seconds, 0.5), 4) AS p50_seconds, round(quantile_cont(seconds, 0.95), 4) AS p95_seconds FROM s""")
def session_duration(spark, d):
    s = cut_lineage(win.sessions(ad.user_events(spark, d), 6 * 3600))
    q = quantile_scalars(s, "seconds", {"p50": 0.5, "p95": 0.95})
    out = s.agg(F.count("*").alias("sessions"), F.sum("events").alias("events"), rnd(F.avg("seconds"), 4).alias("mean_seconds"))
    return out.select("*", rnd(q["p50"], 4).alias("p50_seconds"), rnd(q["p95"], 4).alias("p95_seconds"))


@query("running_explained_variance", """WITH x AS (SELECT unnest(embedding) AS v, generate_subscripts(embedding, 1) AS dim FROM embeddings),
p AS (SELECT CAST(dim AS INT) AS dim, var_pop(CAST(v AS DOUBLE)) AS v FROM x GROUP BY 1), r AS (SELECT dim, row_number() OVER (ORDER BY v DESC, dim) AS rank, v / sum(v) OVER () AS share,
 sum(v) OVER (ORDER BY v DESC, dim ROWS UNBOUNDED PRECEDING) / sum(v) OVER () AS cumulative FROM p)
SELECT dim, rank, round(share, 6) AS share, round(cumulative, 6) AS cumulative, (SELECT min(rank) FROM r WHERE cumulative >= 0.95) AS needed FROM r""")
def running_explained_variance(spark, d):
    vec = src.table(spark, d, "embeddings").select(F.posexplode("embedding").alias("i", "v"))
    parts = vec.groupBy((F.col("i") + 1).alias("dim")).agg(F.var_pop(F.col("v").cast("double")).alias("v"))
    out = win.cumulative_share(parts, "dim", "v", 0.95)
    return out.withColumn("share", rnd("share")).withColumn("cumulative", rnd("cumulative"))


# ---- conversation memories


@query("history_buffer", """SELECT conv_id, turn, row_number() OVER w AS position, CAST(sum(length(text)) OVER w AS BIGINT) AS buffer_chars FROM conversations
WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)""")
def history_buffer(spark, d):
    return ses.history_buffer(ad.conversations(spark, d)).select("conv_id", "turn", "position", "buffer_chars")


@query("history_window_k", """SELECT conv_id, turn, role, age, md5(text) AS digest FROM (SELECT *, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS INT) AS age FROM conversations) WHERE age <= 4""")
def history_window_k(spark, d):
    return ses.history_window(ad.conversations(spark, d), 2).select("conv_id", "turn", "role", "age", F.md5("text").alias("digest"))


BUDGET_SQL = """WITH w AS (SELECT *, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC ROWS UNBOUNDED PRECEDING) AS used,
 row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS age FROM conversations)
"""


@query("history_token_budget", BUDGET_SQL + "SELECT conv_id, turn, role, CAST(used AS BIGINT) AS used_chars FROM w WHERE used <= 1500")
def history_token_budget(spark, d):
    return ses.history_budget(ad.conversations(spark, d), 1500).select("conv_id", "turn", "role", "used_chars")


@query("history_cost_compare", BUDGET_SQL + """SELECT conv_id, CAST(sum(length(text)) AS BIGINT) AS buffer_chars, CAST(coalesce(sum(length(text)) FILTER (WHERE age <= 4), 0) AS BIGINT) AS window_chars,
 CAST(coalesce(sum(length(text)) FILTER (WHERE used <= 1500), 0) AS BIGINT) AS budget_chars FROM w GROUP BY 1""")
def history_cost_compare(spark, d):
    return ses.history_costs(ad.conversations(spark, d), 2, 1500)


@query("user_isolated_history", """SELECT conv_id // 4 AS user_id, count(DISTINCT conv_id) AS sessions, count(*) AS messages, count(*) FILTER (WHERE role = 'user') AS user_messages FROM conversations GROUP BY 1""")
def user_isolated_history(spark, d):
    owned = ad.conversations(spark, d).withColumn("user_id", F.floor(F.col("conv_id") / 4))
    per_session = owned.groupBy("user_id", "conv_id").agg(F.count("*").alias("m"), F.count_if(F.col("role") == "user").alias("u"))
    return per_session.groupBy("user_id").agg(F.count("*").alias("sessions"), F.sum("m").alias("messages"), F.sum("u").alias("user_messages"))


@query("session_migrate", """SELECT conv_id // 4 AS user_id, conv_id, turn, CAST(conv_id % 4 = 0 AS INT) AS migrated,
 row_number() OVER (PARTITION BY conv_id // 4 ORDER BY conv_id % 4 = 0, conv_id, turn, role, text) AS position FROM conversations""")
def session_migrate(spark, d):
    talk = ad.conversations(spark, d).withColumn("user_id", F.floor(F.col("conv_id") / 4))
    anonymous = (F.col("conv_id") % 4) == 0  # each user's first session came before the login
    logins = talk.where(anonymous).select("conv_id", "user_id").distinct()
    out = ses.migrate_sessions(talk.where(~anonymous), talk.where(anonymous), logins)
    return out.select("user_id", "conv_id", "turn", "migrated", "position")


@query("preference_last_write", "SELECT user_id, event_type AS preference, arg_max(props, event_id) AS setting FROM events GROUP BY 1, 2")
def preference_last_write(spark, d):
    ev = ad.user_events(spark, d).select("user_id", F.col("event_type").alias("preference"), "event_id", F.col("props").alias("setting"))
    return newest(ev, ["user_id", "preference"], F.col("event_id"), ["setting"])


SLOTS = {"view": "party_size", "click": "date", "purchase": "time", "signup": "dietary_restrictions", "error": "seating_preference"}


@query("reservation_state", """WITH u AS (SELECT user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type AS e, event_id, json_extract_string(props, '$.k') AS v FROM events),
f AS (SELECT user_id, day, arg_max(v, event_id) FILTER (WHERE e = 'view') AS party_size, arg_max(v, event_id) FILTER (WHERE e = 'click') AS date, arg_max(v, event_id) FILTER (WHERE e = 'purchase') AS time,
 arg_max(v, event_id) FILTER (WHERE e = 'signup') AS dietary_restrictions, arg_max(v, event_id) FILTER (WHERE e = 'error') AS seating_preference FROM u GROUP BY 1, 2)
SELECT *, party_size IS NOT NULL AND date IS NOT NULL AND time IS NOT NULL AS is_complete FROM f""")
def reservation_state(spark, d):
    slot = F.create_map(*[F.lit(x) for kv in SLOTS.items() for x in kv])[F.col("event_type")]
    updates = ad.user_events(spark, d).select(
        "user_id", text(F.to_date("ts")).alias("day"), slot.alias("slot"), F.get_json_object("props", "$.k").alias("v"), "event_id"
    )
    return ses.fold_slots(updates, ["user_id", "day"], "slot", "v", F.col("event_id"), list(SLOTS.values()), ["party_size", "date", "time"])


def turns_sql(limit: int) -> str:
    return f"SELECT conv_id, count(*) FILTER (WHERE role = 'user') AS user_turns FROM conversations GROUP BY 1 HAVING count(*) FILTER (WHERE role = 'user') > {limit}"


@query("escalate_after_5_turns", turns_sql(5))
def escalate_after_5_turns(spark, d, limit: int = 5):
    turns = ad.conversations(spark, d).groupBy("conv_id").agg(F.count_if(F.col("role") == "user").alias("user_turns"))
    return turns.where(F.col("user_turns") > limit)


@query("escalate_after_3_turns", turns_sql(3))
def escalate_after_3_turns(spark, d):
    return escalate_after_5_turns(spark, d, 3)


# ---- checkpoints


@query("latest_checkpoint", "SELECT user_id AS workflow_id, max(event_id) AS seq, arg_max(event_type, event_id) AS node, arg_max(props, event_id) AS state FROM events GROUP BY 1")
def latest_checkpoint(spark, d):
    return win.latest_checkpoints(ad.checkpoints(spark, d), ["workflow_id"]).drop("ts")


@query("latest_checkpoint_at_node", "SELECT user_id AS workflow_id, event_type AS node, max(event_id) AS seq, arg_max(props, event_id) AS state FROM events GROUP BY 1, 2")
def latest_checkpoint_at_node(spark, d):
    return win.latest_checkpoints(ad.checkpoints(spark, d), ["workflow_id", "node"]).drop("ts")


@query("checkpoint_history", "SELECT user_id AS workflow_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS step, event_type AS node, array_to_string(json_keys(props), ',') AS state_keys FROM events")
def checkpoint_history(spark, d):
    return win.checkpoint_trail(ad.checkpoints(spark, d)).select("workflow_id", "step", "node", "state_keys")


@query("checkpoint_as_of", """WITH p AS (SELECT user_id, max(event_id) FILTER (WHERE event_type = 'click') AS q, arg_max(props, event_id) FILTER (WHERE event_type = 'click') AS state FROM events GROUP BY 1)
SELECT e.user_id AS workflow_id, any_value(q) AS replay_seq, any_value(p.state) AS state, count(*) FILTER (WHERE event_id <= q) AS kept, count(*) FILTER (WHERE event_id > q) AS dropped
FROM events e JOIN p ON e.user_id = p.user_id WHERE q IS NOT NULL GROUP BY 1""")
def checkpoint_as_of(spark, d):
    return win.replay_point(ad.checkpoints(spark, d), "click")


@query("cache_hit_flag", with_("requests") + """, h AS (SELECT *, row_number() OVER (PARTITION BY message ORDER BY ts, request_id) > 1 AS is_hit FROM requests)
SELECT endpoint, count(*) AS requests, count(*) FILTER (WHERE is_hit) AS hits, CAST(coalesce(sum(tokens_used) FILTER (WHERE is_hit), 0) AS BIGINT) AS tokens_saved, round(avg(CAST(is_hit AS INT)), 6) AS hit_rate FROM h GROUP BY 1""")
def cache_hit_flag(spark, d):
    h = win.cache_hits(ad.requests(spark, d))
    return h.groupBy("endpoint").agg(
        F.count("*").alias("requests"), F.count_if("is_hit").alias("hits"),
        F.coalesce(F.sum(F.when(F.col("is_hit"), F.col("tokens_used"))), F.lit(0)).alias("tokens_saved"), rnd(F.avg(F.col("is_hit").cast("int"))).alias("hit_rate"),
    )


@query("p95_index_method", with_("requests") + """, r AS (SELECT instance, latency_ms, row_number() OVER (PARTITION BY instance ORDER BY latency_ms) - 1 AS k, count(*) OVER (PARTITION BY instance) AS n FROM requests)
SELECT instance, n, round(latency_ms, 4) AS p95 FROM r WHERE k = CAST(floor(n * 0.95::DOUBLE) AS BIGINT)""")
def p95_index_method(spark, d):
    return win.p95_by_index(ad.requests(spark, d), "latency_ms", ["instance"]).withColumn("p95", rnd("p95", 4))


# ---- 2.7 set operations

WORDS = "list_distinct(regexp_split_to_array(trim(regexp_replace(lower({}), '\\s+', ' ', 'g')), ' '))"
PAIRS_SQL = SESSION_SQL.rstrip() + """, pr AS (SELECT conv_id, p // 2 AS interaction, max(CASE WHEN p % 2 = 0 THEN text END) AS input, max(CASE WHEN p % 2 = 1 THEN text END) AS output FROM pos GROUP BY 1, 2 HAVING count(*) = 2),
w AS (SELECT conv_id, interaction, """ + WORDS.format("input") + " AS e, " + WORDS.format("output") + " AS a FROM pr)\n"


def answered(spark, d):
    """(input, output) message pairs per conversation."""
    return ses.load_sessions(ses.session_pages(ad.conversations(spark, d)))


@query("word_overlap", PAIRS_SQL + "SELECT conv_id AS user_id, interaction, round(len(list_intersect(e, a)) / CAST(len(e) AS DOUBLE), 6) AS overlap FROM w")
def word_overlap(spark, d):
    return answered(spark, d).select("user_id", "interaction", rnd(overlap(F.col("input"), F.col("output"))).alias("overlap"))


PARTIES_SQL = "regexp_extract_all(regexp_replace(text, '[^\\x00-\\x7F]', '0', 'g'), '\\b[A-Z][a-z]+ [A-Z][a-z]+\\b')"


@query("distinct_entities", with_("papers") + f""", f AS (SELECT document_id, {PARTIES_SQL} AS l FROM papers)
SELECT document_id, array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i)[1:5], '|') AS parties FROM f WHERE len(l) > 0""")
def distinct_entities(spark, d):
    found = ad.paperwork(spark, d).select("document_id", first_distinct(parties(F.col("text")), 5).alias("p"))
    return found.where(F.size("p") > 0).select("document_id", F.array_join("p", "|").alias("parties"))


@query("cluster_label_set", "SELECT count(DISTINCT label - 1) FILTER (WHERE label - 1 <> -1) AS clusters, count(*) FILTER (WHERE label - 1 = -1) AS noise FROM embeddings")
def cluster_label_set(spark, d):
    marked = src.table(spark, d, "embeddings").select((F.col("label") - 1).alias("l"))
    return marked.agg(F.countDistinct(F.when(F.col("l") != -1, F.col("l"))).alias("clusters"), F.count_if(F.col("l") == -1).alias("noise"))


@query("union_sessions", "SELECT conv_id, count(*) AS messages, count(*) FILTER (WHERE role <> 'user') AS replies FROM conversations GROUP BY 1")
def union_sessions(spark, d):
    talk = ad.conversations(spark, d)
    asked, told = talk.where(F.col("role") == "user"), talk.where(F.col("role") != "user")
    both = asked.unionByName(told)
    return both.groupBy("conv_id").agg(F.count("*").alias("messages"), F.count_if(F.col("role") != "user").alias("replies"))


@query("users_in_both", """WITH a AS (SELECT c_custkey AS user_id FROM customer), b AS (SELECT DISTINCT user_id FROM events)
SELECT 'both' AS side, count(*) AS users FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL
SELECT 'left_only', count(*) FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT 'right_only', count(*) FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def users_in_both(spark, d):
    a = src.table(spark, d, "customer").select(F.col("c_custkey").alias("user_id"))
    b = ad.user_events(spark, d).select("user_id").distinct()
    sides = {"both": a.intersect(b), "left_only": a.exceptAll(b), "right_only": b.exceptAll(a)}
    out = None
    for name, rows in sides.items():
        one = rows.agg(F.count("*").alias("users")).select(F.lit(name).alias("side"), "users")
        out = one if out is None else out.unionByName(one)
    return out
