"""Hand-worked cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from saltmarsh.functions import special as sp
from saltmarsh.operators import clean, evaluation as ev, retrieval as rt, sessions as ses, textops as tx, windows as win

INVOICE = (
    "INVOICE\n\nInvoice Number: 7\nDate: 01/15/2024\nDue Date: 02/15/2024\n\nBill To:\nAcme Corporation\n\nFrom: Tech Solutions Inc\n\n"
    "Services Rendered:\nConsulting: $15,000.00\nSupport: $2,500.00\n\nTotal: $17,500.00"
)


def docs(spark, *texts):
    return spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "document_id string, text string")


def test_invoice(spark):
    r = tx.process_documents(docs(spark, INVOICE)).first()
    assert (r["document_type"], r["confidence"]) == ("invoice", 0.92)
    assert r["dates"] == ["01/15/2024", "02/15/2024"] and r["amounts"] == [15000.0, 2500.0, 17500.0]
    assert r["is_valid"] and (r["routing_decision"], r["priority"]) == ("accounting", "urgent")
    assert r["summary"] == "Invoice for $15000.0 dated 01/15/2024"
    assert [e["value"] for e in r["entities"]] == ["$15000.0", "01/15/2024"]


def test_contract_and_unknown(spark):
    contract = "AGREEMENT dated 2024-01-10 from 2024-02-01\nJohn Smith of Smith Enterprises\nand Jane Doe of Doe Consulting\npay $5,000 on 2024-01-10."
    a, b = tx.process_documents(docs(spark, contract, "just a short note")).orderBy("document_id").collect()
    assert (a["document_type"], a["routing_decision"], a["priority"]) == ("contract", "legal", "high")
    assert a["parties"] == ["John Smith", "Smith Enterprises", "Jane Doe", "Doe Consulting"] and a["amounts"] == [5000.0]
    assert a["dates"] == ["2024-01-10", "2024-02-01", "2024-01-10"]
    assert (b["document_type"], b["confidence"], b["is_valid"]) == ("unknown", 0.40, False)
    assert b["validation_errors"] == ["Low classification confidence"] and (b["routing_decision"], b["priority"]) == ("review", "high")


def test_amount_edge_and_party_edges(spark):
    r = docs(spark, "a $, and $ 7", "Anna Bé and Éva Kis, Tom Ray").orderBy("document_id").select(tx.amounts(F.col("text")).alias("a"), tx.parties(F.col("text")).alias("p")).collect()
    assert r[0]["a"] == [7.0] and r[1]["p"] == ["Tom Ray"]


def test_moderation(spark):
    texts = ["Great product! Highly recommend.", "BUY NOW!!! 50% OFF CLICK HERE!!!", "This is stupid and annoying.", "I hate you all! Worst people ever!", "Yeah right", "whatever"]
    rows = tx.moderate(docs(spark, *texts)).orderBy("document_id").collect()
    assert [r["content_type"] for r in rows] == ["clean", "spam", "clean", "toxic", "clean", "toxic"]
    assert [r["decision"] for r in rows][:4] == ["approved", "rejected", "approved", "needs_review"]
    whole = docs(spark, "whatever", "I hate it").orderBy("document_id").select(tx.content_type(F.col("text"), word_boundary=True).alias("k")).collect()
    assert [r["k"] for r in whole] == ["clean", "toxic"]
    levels = tx.moderate_levels(docs(spark, *texts)).orderBy("document_id").collect()
    assert [r["level"] for r in levels][:4] == ["clean", "clean", "mild", "severe"]
    assert levels[3]["decision"] == "reject" and levels[3]["violations"] == ["hate_speech"]


def test_evaluation(spark):
    golden = spark.createDataFrame([("1", "Go to Settings > Security > Change Password", "docs", 2000), ("2", "Escalate to human support", "human", 500)], "case_id string, expected_output string, expected_tool string, max_latency_ms int")
    runs = spark.createDataFrame([("1", "Go to Settings, then Security, then Change Password", "DOCS", 1250.0), ("2", "Escalating to our support team", "human", 3500.0)], "case_id string, actual_output string, actual_tool string, latency_ms double")
    scored = ev.score_runs(golden, runs)
    a, b = scored.orderBy("case_id").collect()
    assert (a["accuracy"], a["result"], a["latency_score"]) == (pytest.approx(4 / 7), "partial", 1.0)
    assert (b["accuracy"], b["result"], b["latency_score"]) == (pytest.approx(2 / 4), "partial", 0.5)
    s = ev.summarise_runs(scored).first()
    assert (s["passed"], s["partial"], s["failed"], s["avg_latency_ms"]) == (0, 2, 0, 2375.0)
    assert s["avg_accuracy"] == pytest.approx(15 / 28)


def test_overlap_edges(spark):
    df = spark.createDataFrame([("", ""), ("", "x"), ("a b", "")], "e string, a string")
    assert [r[0] for r in df.select(tx.overlap(F.col("e"), F.col("a"))).collect()] == [1.0, 0.0, 0.0]


def test_approvals(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [(1, "$50", 0.2, "approved", at, at + dt.timedelta(minutes=59)), (2, "$250,000", 0.9, "rejected", at, None), (3, "$250,000", 0.1, "needs_info", at, None), (4, "12", 0.1, "pending", at, None)]
    df = spark.createDataFrame(rows, "id int, amount string, risk_score double, status string, created_at timestamp_ntz, decided_at timestamp_ntz")
    out = {r["id"]: r for r in ev.escalations(df).withColumn("next", ev.next_step(F.col("status"))).collect()}
    assert [out[i]["escalation"] for i in (1, 2, 3, 4)] == [None, "risk", "amount", None]
    assert [out[i]["next"] for i in (1, 2, 3, 4)] == ["execute_action", "cancel_and_notify", "request_more_info", "wait_for_decision"]
    sla = {r["id"]: r for r in ev.sla(df, F.lit(dt.datetime(2024, 1, 2, 3, 20)).cast("timestamp_ntz"), 24).collect()}
    assert (sla[1]["pending_for"], sla[4]["pending_for"], sla[4]["is_stale"], sla[1]["is_breached"]) == ("59m", "27h 20m", True, False)


def test_request_p95(spark):
    df = spark.createDataFrame([(float(800 + 100 * i),) for i in range(10)], "latency_ms double")
    assert win.p95_by_index(df, "latency_ms").first()["p95"] == 1700.0


def test_history_window_and_pairs(spark):
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", f"m{t}") for t in range(9)]
    talk = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    assert sorted(r["turn"] for r in ses.history_window(talk, 2).collect()) == [5, 6, 7, 8]
    pairs = ses.load_sessions(ses.session_pages(talk, 4), 4).orderBy("interaction").collect()
    assert [(p["input"], p["output"]) for p in pairs] == [("m0", "m1"), ("m2", "m3"), ("m4", "m5"), ("m6", "m7")]
    assert [r["turn"] for r in ses.history_budget(talk, 5).orderBy("turn").collect()] == [7, 8]


def test_bins_and_segments(spark):
    df = spark.createDataFrame([(0.0,), (5000.0,), (5000.5,), (100000.0,), (100001.0,)], "v double")
    got = [r[0] for r in df.select(clean.bin_cut(F.col("v"), [0, 5000, 15000, 100000], ["Low", "Medium", "High"])).collect()]
    assert got == [None, "Low", "Medium", "High", None]


def test_ticket_and_mail(spark):
    text = "export keeps failing with ERR_TIMEOUT_500, timeout error.\n  1. Go to Export\n  2. Choose CSV\nPlease help ASAP! alice@example.com"
    r = tx.triage(tx.ticket_fields(docs(spark, text))).first()
    assert (r["error_code"], r["affected_feature"], r["email"], r["steps"]) == ("ERR_TIMEOUT_500", "export", "alice@example.com", ["Go to Export", "Choose CSV"])
    assert (r["category"], r["priority"], r["team"], r["escalate"], r["priority_label"]) == ("bug", 5, "engineering", True, "HIGH")
    m = tx.triage_mail(docs(spark, "URGENT: demo tomorrow. Send slides by 8pm", "50% OFF! Buy now!")).orderBy("document_id").collect()
    assert [x["category"] for x in m] == ["urgent", "spam"] and m[0]["deadlines"] == ["8pm"]


def test_redact_and_render(spark):
    r = docs(spark, "John Smith, a.b@c.org, 4111 1111 1111 1111").select(tx.redact(F.col("text"))).first()[0]
    assert r == "[NAME], [EMAIL], [CARD]"
    df = spark.createDataFrame([("x", None)], "a string, b string")
    filled, empty = tx.render("{a} and {b}", {"a": F.col("a"), "b": F.col("b")})
    assert df.select(filled, empty).first()[:] == (None, ["b"])


def test_reply_records(spark):
    raw = ['{"category": "bug", "priority": 3, "sentiment": "angry"}', '{"category": "odd", "priority": 9}', '{"category": "bug", "pri', None]
    rows = tx.parse_reply(spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, raw string"), "raw").orderBy("i").collect()
    assert [r["errors"] for r in rows] == [[], ["bad category", "bad priority"], ["unreadable"], ["unreadable"]]


def test_sections_and_fixed_chunks(spark):
    df = docs(spark, "intro\n## A\nx\n## B\ny")
    assert [r["chunk"] for r in rt.section_chunks(df, "text").orderBy("chunk_index").collect()] == ["intro\n", "## A\nx\n", "## B\ny"]
    text = "abcdefghij" * 7
    parts = [r["chunk"] for r in rt.fixed_chunks(docs(spark, text), "text", 30, 5).orderBy("chunk_index").collect()]
    assert parts[0] + "".join(p[5:] for p in parts[1:]) == text and all(len(p) <= 30 for p in parts)


@pytest.mark.parametrize("size,overlap", [(40, 8), (25, 0), (300, 50)])
def test_recursive_chunks(size, overlap):
    text = ("one two three four five six seven\n\n" * 3 + "x" * 95 + "\n" + "alpha beta gamma " * 12) * 2
    parts = rt.split_recursively(text, size, overlap, ("\n\n", "\n", " ", ""))
    assert all(0 < len(p) <= size for p in parts)
    assert set(text.split()) - {"x" * 95} <= set(" ".join(parts).split()) | set()
    at = 0
    for p in parts:  # pieces keep the order of the text
        found = text.find(p, max(0, at - size))
        assert found >= 0
        at = found
    assert sum(p.count("x") for p in parts) >= 2 * 95
    if overlap == 0:
        assert "".join("".join(p.split()) for p in parts) == "".join(text.split())


def test_tail_probabilities():
    # reference values from published tables
    assert sp.chi2_sf(3.841459, 1) == pytest.approx(0.05, abs=1e-6)
    assert sp.t_two_sided(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert sp.f_sf(4.102821, 2, 10) == pytest.approx(0.05, abs=1e-6)
    assert sp.normal_two_sided(1.959964) == pytest.approx(0.05, abs=1e-6)
    import math

    def cdf(k, n, p):
        return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))

    for n, p, q in [(50, 0.16, 0.025), (60, 0.2, 0.975), (10, 0.5, 0.5)]:
        k = sp.binomial_quantile(q, n, p)
        assert cdf(k, n, p) >= q and (k == 0 or cdf(k - 1, n, p) < q)


def test_sparse_columns_and_imputing(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "a"), (3, 5.0, None)], "i int, x double, c string")
    assert clean.drop_sparse_columns(df, 0.5).columns == ["i", "c"]
    out = {r["i"]: r for r in clean.impute(df, [], ["x"], ["c"]).collect()}
    assert out[1]["x"] == 5.0 and out[1]["x_missing"] == 1 and out[3]["c"] == "a" and out[3]["c_missing"] == 1


def test_budget_match_is_exact(spark):
    products = spark.createDataFrame([(1, "red", 10.0), (2, "red", 20.0), (3, "blue", 5.0)], "id bigint, colour string, price double")
    users = spark.createDataFrame([(1, "red", 20.0), (2, "red", 9.0), (3, "blue", 100.0)], "user_id bigint, colour string, budget double")
    out = {r["user_id"]: (r["matches"], r["best_id"]) for r in tx.rank_within_budget(products, users, F.floor(F.col("at") / 10)).collect()}
    assert out == {1: (2, 2), 2: (0, None), 3: (1, 3)}
