"""Text rules as column expressions: classify, extract, validate, summarise, route."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- fixed values: keyword lists, patterns, messages

DOCUMENT_KEYWORDS = {
    "invoice": ["invoice", "payment", "bill", "amount due"],
    "contract": ["agreement", "contract", "hereby agree"],
    "report": ["report", "analysis", "findings"],
}
DOCUMENT_CONFIDENCE = {"invoice": 0.92, "contract": 0.88, "report": 0.85, "unknown": 0.40}
SIMPLE_KEYWORDS = {"invoice": ["invoice", "payment"], "contract": ["agreement", "contract"]}
DATE_PATTERN = r"\d{1,2}[-/]\d{1,2}[-/]\d{2,4}|\d{4}[-/]\d{1,2}[-/]\d{1,2}"
AMOUNT_PATTERN = r"\$\s*([0-9,]+\.?[0-9]*)"
# (?U): word boundaries and letters follow Unicode
PARTY_PATTERN = r"(?U)\b[A-Z][a-z]+ [A-Z][a-z]+\b"
CONTENT_KEYWORDS = {"spam": ["buy now"], "toxic": ["hate"]}
CONTENT_DECISIONS = {
    "spam": ("rejected", "Spam detected - auto-rejected"),
    "toxic": ("needs_review", "Toxic content - queued for human review"),
    "clean": ("approved", "Clean content - approved for publication"),
}
TOXICITY_KEYWORDS = {
    "severe": ["i hate you", "disgusting"],
    "toxic": ["hate", "worthless", "trash"],
    "mild": ["stupid", "annoying", "clown"],
}
TOXICITY_DECISIONS = {"severe": "reject", "toxic": "review", "mild": "warn", "clean": "approve"}
POLICY_KEYWORDS = {
    "hate_speech": ["hate"],
    "harassment": ["stupid", "worthless", "clown", "trash", "disgusting"],
    "promotion": ["buy now", "click here", "% off"],
}
STOP_WORDS = {
    "de": ["der", "die", "und", "das", "den", "ein", "nicht", "mit"],
    "en": ["the", "of", "and", "to", "in", "is", "that", "for"],
    "es": ["el", "los", "que", "y", "del", "por", "una", "con"],
    "fr": ["le", "les", "et", "des", "une", "qui", "dans", "du"],
}
TICKET_KEYWORDS = {
    "bug": ["fails", "error", "not working", "timeout"],
    "billing": ["invoice", "billing", "refund"],
    "feature_request": ["feature request", "please add"],
    "question": ["how do i", "?"],
}
TICKET_TEAMS = {"bug": "engineering", "billing": "billing", "feature_request": "product", "question": "support", "urgent": "support"}
TICKET_PRIORITY = {"bug": 3, "billing": 2, "feature_request": 1, "question": 1, "urgent": 4}
URGENT_WORDS = ["urgent", "asap", "emergency", "blocking"]
EMAIL_KEYWORDS = {
    "spam": ["buy now", "% off", "click here"],
    "urgent": ["urgent", "asap", "by tonight", "by tomorrow"],
    "follow_up": ["?", "let me know"],
}
EMAIL_PATTERN = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
CARD_PATTERN = r"[0-9](?:[ -]?[0-9]){12,15}"


def any_word(lowered: Column, words: list[str], word_boundary: bool = False) -> Column:
    """True when one of ``words`` occurs; as substring unless ``word_boundary``."""
    if word_boundary:
        return lowered.rlike(r"(?U)\b(?:" + "|".join(rf"\Q{w}\E" for w in words) + r")\b")
    return reduce(lambda a, b: a | b, [lowered.contains(w) for w in words])


def first_match(text: Column, lists: dict[str, list[str]], default: str, word_boundary: bool = False) -> Column:
    """Name of the first keyword list that has a word in ``text``."""
    lowered = F.lower(text)
    return F.coalesce(*[F.when(any_word(lowered, words, word_boundary), name) for name, words in lists.items()], F.lit(default))


def lookup(key: Column, values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[key]


# ---- moderation


def content_type(text: Column, word_boundary: bool = False) -> Column:
    return first_match(text, CONTENT_KEYWORDS, "clean", word_boundary)


def moderate(df: DataFrame, text: str = "text") -> DataFrame:
    """Content type, decision and reason per row."""
    kind = content_type(F.col(text))
    return df.withColumn("content_type", kind).select(
        "*",
        lookup(F.col("content_type"), {k: v[0] for k, v in CONTENT_DECISIONS.items()}).alias("decision"),
        lookup(F.col("content_type"), {k: v[1] for k, v in CONTENT_DECISIONS.items()}).alias("summary"),
    )


def moderate_levels(df: DataFrame, text: str = "text") -> DataFrame:
    """Toxicity level, its decision, and the policies each text breaks."""
    lowered = F.lower(F.col(text))
    broken = F.filter(F.array(*[F.when(any_word(lowered, w), name) for name, w in POLICY_KEYWORDS.items()]), lambda x: x.isNotNull())
    df = df.withColumn("level", first_match(F.col(text), TOXICITY_KEYWORDS, "clean"))
    return df.withColumn("decision", lookup(F.col("level"), TOXICITY_DECISIONS)).withColumn("violations", broken)


# ---- documents


def plain_number(x: Column) -> Column:
    """A float written out, at least one decimal, no exponent."""
    digits = F.regexp_replace(x.cast("decimal(38,6)").cast("string"), "0+$", "")
    return F.when(digits.endswith("."), F.concat(digits, F.lit("0"))).otherwise(digits)


def dates(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(DATE_PATTERN), 0)


def amounts(text: Column) -> Column:
    """Dollar amounts; what does not read as a number is dropped."""
    found = F.regexp_extract_all(text, F.lit(AMOUNT_PATTERN), 1)
    read = F.transform(found, lambda s: F.regexp_replace(s, ",", "").try_cast("double"))
    return F.filter(read, lambda x: x.isNotNull())


def parties(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(PARTY_PATTERN), 0)


def first_distinct(items: Column, n: int) -> Column:
    return F.slice(F.array_distinct(items), 1, n)


def classify(df: DataFrame, text: str = "text") -> DataFrame:
    kind = first_match(F.col(text), DOCUMENT_KEYWORDS, "unknown")
    df = df.withColumn("document_type", kind)
    return df.withColumn("confidence", lookup(F.col("document_type"), DOCUMENT_CONFIDENCE))


def extract(df: DataFrame, text: str = "text") -> DataFrame:
    """Dates, amounts, the first five parties, and the leading entities."""
    c = F.col(text)
    df = df.withColumn("dates", dates(c)).withColumn("amounts", amounts(c)).withColumn("parties", first_distinct(parties(c), 5))
    money, date = F.get("amounts", 0), F.get("dates", 0)
    entity = [
        F.when(money.isNotNull(), F.struct(F.lit("monetary_amount").alias("type"), F.concat(F.lit("$"), plain_number(money)).alias("value"))),
        F.when(date.isNotNull(), F.struct(F.lit("date").alias("type"), date.alias("value"))),
    ]
    return df.withColumn("entities", F.filter(F.array(*entity), lambda e: e.isNotNull()))


def validate(df: DataFrame) -> DataFrame:
    """Rule errors per document; valid when there are none."""
    kind = F.col("document_type")
    rules = [
        F.when((kind == "invoice") & (F.size("amounts") == 0), "Invoice missing amount"),
        F.when((kind == "invoice") & (F.size("dates") == 0), "Invoice missing date"),
        F.when((kind == "contract") & (F.size("parties") < 2), "Contract missing parties"),
        F.when(F.col("confidence") < 0.7, "Low classification confidence"),
    ]
    df = df.withColumn("validation_errors", F.filter(F.array(*rules), lambda e: e.isNotNull()))
    return df.withColumn("is_valid", F.size("validation_errors") == 0)


def summarise(df: DataFrame, text: str = "text", language: str = "en") -> DataFrame:
    """Summary sentence and key points by document type."""
    kind = F.col("document_type")
    money = F.coalesce(plain_number(F.get("amounts", 0)), F.lit("unknown"))
    date = F.coalesce(F.get("dates", 0), F.lit("unknown"))
    summary = (
        F.when(kind == "invoice", F.concat(F.lit("Invoice for $"), money, F.lit(" dated "), date))
        .when(kind == "contract", F.concat(F.lit("Contract agreement between "), F.size("parties").cast("string"), F.lit(" parties")))
        .otherwise(F.concat(F.initcap(kind), F.lit(" document with "), F.length(text).cast("string"), F.lit(" characters")))
    )
    points = (
        F.when(kind == "invoice", F.array(
            F.concat(F.lit("Amount due: $"), money), F.concat(F.lit("Date: "), date),
            F.concat(F.lit("Entities extracted: "), F.size("entities").cast("string"))))
        .when(kind == "contract", F.array(
            F.concat(F.lit("Parties: "), F.array_join(F.slice("parties", 1, 3), ", ")),
            F.concat(F.lit("Dates mentioned: "), F.size("dates").cast("string"))))
        .otherwise(F.array(F.concat(F.lit("Type: "), kind), F.lit(f"Language: {language}")))
    )
    return df.withColumn("summary", summary).withColumn("key_points", points)


def route(df: DataFrame, urgent_above: float = 10_000) -> DataFrame:
    kind, bad = F.col("document_type"), ~F.col("is_valid")
    desk = F.when(bad, "review").otherwise(
        F.coalesce(lookup(kind, {"invoice": "accounting", "contract": "legal", "report": "management"}), F.lit("review"))
    )
    big = F.coalesce(F.get("amounts", 0) > urgent_above, F.lit(False))
    priority = (
        F.when(bad, "high").when(kind == "invoice", F.when(big, "urgent").otherwise("medium"))
        .when(kind == "contract", "high").when(kind == "report", "low").otherwise("medium")
    )
    return df.withColumn("routing_decision", desk).withColumn("priority", priority)


def process_documents(df: DataFrame) -> DataFrame:
    """Classify, extract, validate, summarise and route: one narrow stage, no shuffle."""
    return route(summarise(validate(extract(classify(df)))))


def text_error(text: Column) -> Column:
    return (
        F.when(F.coalesce(F.length(text), F.lit(0)) == 0, "Empty document")
        .when(F.length(text) < 10, "Document too short").otherwise("")
    )


def words(text: Column) -> Column:
    """Lower-cased words between whitespace; empty text has none."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def overlap(expected: Column, actual: Column) -> Column:
    """Share of the expected distinct words that occur; 1 when both are empty, 0 when only expected is."""
    e, a = F.array_distinct(words(expected)), F.array_distinct(words(actual))
    return (
        F.when(F.size(e) > 0, F.size(F.array_intersect(e, a)) / F.size(e))
        .when(F.size(a) == 0, 1.0).otherwise(0.0)
    )


def with_language(df: DataFrame, text: str = "text") -> DataFrame:
    """``detected``: the language with the most stop words, 'unknown' without any; ties go to the first code."""
    every = sorted({w for stops in STOP_WORDS.values() for w in stops})
    # one pass over the words keeps the few that count
    df = df.withColumn("_stops", F.filter(F.split(F.lower(text), r"\s+"), lambda w: w.isin(every)))

    def hits(stops):
        return F.size(F.filter("_stops", lambda w: w.isin(stops)))

    best = F.array_max(F.array(*[
        F.struct(hits(stops).alias("hits"), F.lit(-i).alias("order"), F.lit(code).alias("code"))
        for i, (code, stops) in enumerate(STOP_WORDS.items())
    ]))
    df = df.withColumn("_best", best)
    return df.withColumn("detected", F.when(F.col("_best.hits") > 0, F.col("_best.code")).otherwise("unknown")).drop("_stops", "_best")


# ---- tickets and mails


def ticket_fields(df: DataFrame, text: str = "text") -> DataFrame:
    c = F.col(text)

    def found(pattern, group):
        return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))

    return df.select(
        "*",
        found(r"(ERR_[A-Z0-9_]+)", 1).alias("error_code"),
        found(r"(?i)\b(export|dashboard|login|invoice|dark mode)\b", 1).alias("affected_feature"),
        found(EMAIL_PATTERN, 0).alias("email"),
        F.regexp_extract_all(c, F.lit(r"(?m)^\s*[0-9]+\.\s*(.+)$"), 1).alias("steps"),
    )


def triage(df: DataFrame, text: str = "text") -> DataFrame:
    """Category, priority, team and escalation by keyword rules."""
    lowered = F.lower(F.col(text))
    urgent = any_word(lowered, URGENT_WORDS)
    df = df.withColumn("category", F.coalesce(first_match(F.col(text), TICKET_KEYWORDS, "question")))
    priority = F.least(lookup(F.col("category"), TICKET_PRIORITY) + F.when(urgent, 2).otherwise(0), F.lit(5))
    df = df.withColumn("priority", priority)
    return df.select(
        "*", lookup(F.col("category"), TICKET_TEAMS).alias("team"), (F.col("priority") >= 4).alias("escalate"),
        F.when(F.col("priority") >= 4, "HIGH").otherwise("MEDIUM").alias("priority_label"),
    )


def triage_mail(df: DataFrame, text: str = "text") -> DataFrame:
    c = F.col(text)
    kind = first_match(c, EMAIL_KEYWORDS, "normal")
    items = F.regexp_extract_all(c, F.lit(r"(?i)\bby ([0-9]{1,2}(?:am|pm)|tonight|tomorrow)\b"), 1)
    return df.withColumn("category", kind).withColumn("deadlines", items)


def redact(text: Column) -> Column:
    """E-mail addresses, card numbers and two-word names replaced by tags."""
    out = F.regexp_replace(text, EMAIL_PATTERN, "[EMAIL]")
    out = F.regexp_replace(out, CARD_PATTERN, "[CARD]")
    return F.regexp_replace(out, PARTY_PATTERN, "[NAME]")


def parse_money(text: Column) -> Column:
    return F.regexp_replace(text, r"[$,]", "").try_cast("double")


def pending_text(minutes: Column) -> Column:
    """Minutes as '12m' or '3h 20m'."""
    whole = F.floor(minutes)
    hours = F.concat(F.floor(minutes / 60).cast("string"), F.lit("h "), (whole % 60).cast("string"), F.lit("m"))
    return F.when(minutes < 60, F.concat(whole.cast("string"), F.lit("m"))).otherwise(hours)


def render(template: str, slots: dict[str, Column]) -> tuple[Column, Column]:
    """The filled template, NULL when a slot is, and the names of the empty slots."""
    parts, rest = [], template
    while "{" in rest:
        head, tail = rest.split("{", 1)
        name, rest = tail.split("}", 1)
        parts += [F.lit(head), slots[name].cast("string")]
    filled = F.concat(*parts, F.lit(rest))
    empty = F.filter(F.array(*[F.when(c.isNull(), n) for n, c in slots.items()]), lambda x: x.isNotNull())
    return filled, empty


def unit(vector: Column) -> Column:
    """The vector over its length, in double precision."""
    v = F.transform(vector, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.transform(v, lambda x: x / norm)


def rank_within_budget(products: DataFrame, users: DataFrame, block: Column) -> DataFrame:
    """Per user: how many products of the wanted colour cost at most the budget, and the dearest of them.

    Products and budgets are put in one price order per colour, so no user-product pairs arise.
    """
    from ..functions.scale import running

    rows = products.select("colour", F.col("price").alias("at"), F.lit(0).alias("side"), F.col("id").alias("key")).unionByName(
        users.select("colour", F.col("budget").alias("at"), F.lit(1).alias("side"), F.col("user_id").alias("key"))
    )
    ranked = running(rows, ["colour"], ["at", "side", "key"], block, rank=(1 - F.col("side")).cast("bigint"))
    asked = ranked.where("side = 1").select(F.col("key").alias("user_id"), "colour", F.col("at").alias("budget"), F.col("rank").alias("matches"))
    best = ranked.where("side = 0").select("colour", F.col("rank").alias("matches"), F.col("key").alias("best_id"), F.col("at").alias("best_price"))
    return asked.join(best, ["colour", "matches"], "left")


# What a triage record may hold.
REPLY_SCHEMA = "category STRING, priority INT, sentiment STRING"
REPLY_CATEGORIES = ["bug", "feature_request", "question", "billing", "urgent"]


def parse_reply(df: DataFrame, raw: str) -> DataFrame:
    """Typed record from model JSON; unreadable text, unknown categories and priorities outside 1-5 are listed."""
    df = df.withColumn("_r", F.from_json(raw, REPLY_SCHEMA))
    c, p = F.col("_r.category"), F.col("_r.priority")
    # a half-read record counts as unreadable
    readable = F.try_parse_json(F.col(raw)).isNotNull()
    checks = [
        F.when(~readable | c.isNull(), "unreadable"),
        F.when(readable & ~c.isin(REPLY_CATEGORIES), "bad category"),
        F.when(readable & ~p.between(1, 5), "bad priority"),
    ]
    return df.select(
        "*", *[F.when(readable, F.col(f"_r.{n}")).alias(n) for n in ("category", "priority", "sentiment")],
        F.filter(F.array(*checks), lambda e: e.isNotNull()).alias("errors"),
    ).drop("_r")


def chat(shots: list[tuple[str, str]], question: Column) -> Column:
    """System message, examples and the question as one message array."""
    rows = [(F.lit(role), F.lit(content)) for role, content in shots] + [(F.lit("human"), question)]
    return F.array(*[F.struct(r.alias("role"), c.alias("content")) for r, c in rows])
