"""The subject tables as DuckDB common table expressions, shared by the oracle SQL."""

from __future__ import annotations

CTES = {
    "subs": """subs AS (
  SELECT c.c_custkey AS user_id, c.c_mktsegment AS plan_tier, r.r_name AS region, o.signup_date,
         CASE WHEN o.last_date < DATE '2001-08-02' - 365 THEN o.last_date END AS churn_date,
         date_diff('day', o.signup_date, CASE WHEN o.last_date < DATE '2001-08-02' - 365 THEN o.last_date ELSE DATE '2001-08-02' END) AS tenure_days,
         o.spend / greatest(date_diff('day', o.signup_date, CASE WHEN o.last_date < DATE '2001-08-02' - 365 THEN o.last_date ELSE DATE '2001-08-02' END) / 30.0::DOUBLE, 1.0::DOUBLE) AS mrr
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey
  LEFT JOIN (SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS signup_date, CAST(max(o_orderdate) AS DATE) AS last_date,
                    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS spend FROM orders GROUP BY 1) o
    ON c.c_custkey = o.o_custkey)""",
    "usage": """usage AS (
  SELECT o.o_custkey AS user_id, p.p_brand AS feature_name, l.l_quantity AS usage_count, CAST(l.l_shipdate AS DATE) AS date
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey)""",
    "feedback": """feedback AS (
  SELECT d.doc_id AS feedback_id, d.doc_id % 150 AS user_id, d.source AS category, l.quality - l.toxic AS score,
         CASE WHEN l.quality - l.toxic > 0 THEN 'positive' WHEN l.quality - l.toxic < 0 THEN 'negative'
              WHEN l.quality - l.toxic = 0 THEN 'neutral' END AS sentiment, d.text
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""",
    "catalog": """catalog AS (
  SELECT p_partkey AS feature_id, p_brand AS feature_name, p_type AS tier, DATE '1994-01-01' + p_size * 7 AS release_date,
         split_part(p_name, ' ', -1) AS owner_team FROM part)""",
    "requests": """requests AS (
  SELECT event_id AS request_id, 'instance-' || (event_id % 3) AS instance, event_type AS endpoint, props AS message, ts, user_id,
         value * 10 AS latency_ms, CAST(floor(value) AS BIGINT) AS tokens_used, event_type = 'error' AS is_error FROM events)""",
    "checkpoints": """checkpoints AS (
  SELECT user_id AS workflow_id, event_id AS seq, event_type AS node, props AS state, ts FROM events)""",
    "approvals": """approvals AS (
  SELECT o.o_orderkey AS id, o.o_custkey AS requester, format('${:,.2f}', o.o_totalprice) AS amount,
         (6 - CAST(substr(o.o_orderpriority, 1, 1) AS INT)) / 5.0::DOUBLE AS risk_score,
         CASE o.o_orderstatus WHEN 'F' THEN 'approved' WHEN 'O' THEN 'rejected' ELSE 'pending' END AS status,
         o.o_orderdate AS created_at, CASE WHEN o.o_orderstatus IN ('F', 'O') THEN s.first_ship END AS decided_at
  FROM orders o LEFT JOIN (SELECT l.l_orderkey, min(l.l_shipdate) AS first_ship FROM lineitem l JOIN orders p
       ON l.l_orderkey = p.o_orderkey WHERE l.l_shipdate >= p.o_orderdate GROUP BY 1) s ON o.o_orderkey = s.l_orderkey)""",
    "papers": """papers AS (
  SELECT 'doc-' || doc_id AS document_id, text, source FROM documents
  UNION ALL
  SELECT 'order-' || o_orderkey,
    CASE o_orderstatus
      WHEN 'F' THEN 'INVOICE ' || o_orderkey || chr(10) || 'Date: ' || strftime(o_orderdate, '%m/%d/%Y') || chr(10) || 'Sold by Harbor Supplies to '
        || substr(c_mktsegment, 1, 1) || lower(substr(c_mktsegment, 2)) || ' Holdings' || chr(10) || 'Amount due: '
        || CASE WHEN o_orderpriority = '5-LOW' THEN 'on request' ELSE format('${:,.2f}', o_totalprice) END
      WHEN 'O' THEN 'This contract of ' || strftime(o_orderdate, '%Y-%m-%d') || ' binds ' || substr(c_mktsegment, 1, 1) || lower(substr(c_mktsegment, 2)) || ' Holdings'
        || CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ' alone' ELSE ' and Harbor Supplies' END
        || '. They hereby agree to pay ' || format('${:,.2f}', o_totalprice) || '.'
      ELSE 'Quarter findings for ' || substr(c_mktsegment, 1, 1) || lower(substr(c_mktsegment, 2)) || ' buyers: order ' || o_orderkey || ' brought '
        || format('${:,.2f}', o_totalprice) || '.' END, 'orders'
  FROM orders JOIN customer ON o_custkey = c_custkey)""",
    "tickets": """tickets AS (
  SELECT event_id AS ticket_id, user_id, CASE event_type
    WHEN 'error' THEN 'The export fails with ERR_EXPORT_' || json_extract_string(props, '$.k') || '.' || chr(10) || '1. Open reports' || chr(10) || '2. Click export ' || json_extract_string(props, '$.k') || chr(10) || 'Please help ASAP, needed by 8pm'
    WHEN 'click' THEN 'Please add a dark mode, feature request ' || json_extract_string(props, '$.k')
    WHEN 'purchase' THEN 'My invoice shows ' || format('${:,.2f}', value) || ' and I want a refund by tomorrow'
    WHEN 'view' THEN 'How do I open the dashboard?'
    ELSE '50% OFF for ' || json_extract_string(props, '$.k') || ' days! Buy now! Click here!' END || chr(10) || 'user_' || user_id || '@example.com' AS text FROM events)""",
    "docs": r"""docs AS (
  WITH a AS (SELECT document_id, text, source, CASE WHEN regexp_matches(lower(text), 'invoice|payment|bill|amount due') THEN 'invoice'
      WHEN regexp_matches(lower(text), 'agreement|contract|hereby agree') THEN 'contract' WHEN regexp_matches(lower(text), 'report|analysis|findings') THEN 'report' ELSE 'unknown' END AS document_type,
    regexp_extract_all(text, '[0-9]{1,2}[-/][0-9]{1,2}[-/][0-9]{2,4}|[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}') AS dates,
    list_filter(list_transform(regexp_extract_all(text, '\$\s*([0-9,]+\.?[0-9]*)', 1), lambda x: try_cast(replace(x, ',', '') AS DOUBLE)), lambda x: x IS NOT NULL) AS amounts,
    regexp_extract_all(regexp_replace(text, '[^\x00-\x7F]', '0', 'g'), '\b[A-Z][a-z]+ [A-Z][a-z]+\b') AS all_parties FROM papers),
  b AS (SELECT *, list_filter(all_parties, lambda x, i: list_position(all_parties, x) = i)[1:5] AS parties,
    CASE document_type WHEN 'invoice' THEN 0.92 WHEN 'contract' THEN 0.88 WHEN 'report' THEN 0.85 ELSE 0.40 END::DOUBLE AS confidence,
    rtrim(CASE WHEN amounts[1] = floor(amounts[1]) AND amounts[1] < 1e18 THEN CAST(CAST(amounts[1] AS BIGINT) AS VARCHAR) || '.0' ELSE CAST(CAST(amounts[1] AS DECIMAL(38,6)) AS VARCHAR) END, '0') AS m0 FROM a),
  c AS (SELECT *, CASE WHEN m0 LIKE '%.' THEN m0 || '0' ELSE m0 END AS money,
    list_filter([CASE WHEN document_type = 'invoice' AND len(amounts) = 0 THEN 'Invoice missing amount' END, CASE WHEN document_type = 'invoice' AND len(dates) = 0 THEN 'Invoice missing date' END,
      CASE WHEN document_type = 'contract' AND len(parties) < 2 THEN 'Contract missing parties' END, CASE WHEN confidence < 0.7 THEN 'Low classification confidence' END], lambda x: x IS NOT NULL) AS errors FROM b)
  SELECT *, len(errors) = 0 AS is_valid,
    list_filter([CASE WHEN money IS NOT NULL THEN 'monetary_amount=$' || money END, CASE WHEN dates[1] IS NOT NULL THEN 'date=' || dates[1] END], lambda x: x IS NOT NULL) AS entities,
    CASE document_type WHEN 'invoice' THEN 'Invoice for $' || coalesce(money, 'unknown') || ' dated ' || coalesce(dates[1], 'unknown')
      WHEN 'contract' THEN 'Contract agreement between ' || len(parties) || ' parties'
      ELSE upper(document_type[1]) || document_type[2:] || ' document with ' || length(text) || ' characters' END AS summary,
    CASE WHEN len(errors) > 0 THEN 'review' WHEN document_type = 'invoice' THEN 'accounting' WHEN document_type = 'contract' THEN 'legal' WHEN document_type = 'report' THEN 'management' ELSE 'review' END AS routing_decision,
    CASE WHEN len(errors) > 0 THEN 'high' WHEN document_type = 'invoice' THEN CASE WHEN amounts[1] > 10000 THEN 'urgent' ELSE 'medium' END
      WHEN document_type = 'contract' THEN 'high' WHEN document_type = 'report' THEN 'low' ELSE 'medium' END AS priority
  FROM c)""",
    "ev": "ev AS (SELECT user_id, count(*) AS total_events FROM events GROUP BY 1)",
    "uf": """uf AS (SELECT user_id, sum(usage_count) AS total_usage, count(DISTINCT feature_name) AS feature_count FROM usage GROUP BY 1)""",
    "profile": """profile AS (
  SELECT s.* REPLACE (coalesce(s.tenure_days, 0) AS tenure_days, coalesce(s.mrr, 0.0) AS mrr), s.churn_date IS NOT NULL AS is_churned, CAST(s.churn_date IS NOT NULL AS INT) AS churned,
         coalesce(e.total_events, 0) AS total_events, coalesce(u.total_usage, 0.0) AS total_usage,
         coalesce(u.feature_count, 0) AS feature_count,
         coalesce(u.total_usage, 0.0) / (coalesce(s.tenure_days, 0) + 1) AS usage_per_day,
         coalesce(e.total_events, 0) / CAST(coalesce(s.tenure_days, 0) + 1 AS DOUBLE) AS events_per_day
  FROM subs s LEFT JOIN ev e ON s.user_id = e.user_id LEFT JOIN uf u ON s.user_id = u.user_id)""",
}

NEEDS = {"docs": ("papers",), "uf": ("usage",), "profile": ("subs", "usage", "ev", "uf")}


def with_(*names: str, extra: str = "") -> str:
    """``WITH`` clause naming the wanted subject tables, then ``extra`` ones."""
    wanted: list[str] = []
    for n in names:
        wanted += [m for m in (*NEEDS.get(n, ()), n) if m not in wanted]
    parts = [CTES[n] for n in wanted] + ([extra] if extra else [])
    return "WITH " + ",\n".join(parts) + "\n"
