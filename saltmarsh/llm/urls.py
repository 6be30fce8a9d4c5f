"""URL filters: rules, then a character language-model ratio. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.session import cut_lineage

#: The rules (host and path, verdict).
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
ORDER = 4  # characters of context at most
SMOOTH = 2.0  # weight of the next shorter context in counts
SMALL = 1_000_000  # model rows that may be broadcast (about 40 bytes each)
SALTS = 16


def host_and_path(url: Column | str) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: from there up to ``?`` or ``#``."""
    url = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    host = F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule that fits as (rule, verdict), or null."""
    best = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        domain, _, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith("/" + rest)
        best = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(best)
    return best


def _grams(df: DataFrame, text: Column, keep: list, order: int) -> DataFrame:
    """One row per character: the character with its ``order`` characters of context; the text is padded in front."""
    padded = F.concat(F.lit("\x02" * order), text, F.lit("\x03"))
    at = F.sequence(F.lit(1), F.length(padded) - order)
    return df.select(*keep, F.explode(F.transform(at, lambda i: F.substring(padded, i, F.lit(order + 1)))).alias("gram"))


def character_model(texts: DataFrame, order: int = ORDER, smooth: float = SMOOTH) -> DataFrame:
    """(gram, ratio) for every gram of ``texts`` (text, label 1, 0 or null, n): ln P(char | context) of the accepted
    less that of the rejected.

    In both models a context's estimate is its count with ``smooth`` times the estimate of the
    context one character shorter added, down to a uniform one over 256 characters. Contexts and
    grams that only unlabelled texts hold are smoothed the same way.
    """
    grams = _grams(texts, F.col("text"), ["label", "n"], order).groupBy("gram").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("r")
    )
    now = cut_lineage(grams)
    out = now.select("gram")
    uniform = F.lit(1 / 256)
    probability = {"a": uniform, "r": uniform}
    for length in range(order + 1):
        tail = F.expr(f"substring(gram, {order + 1 - length}, {length + 1})")
        sums = now.select(tail.alias("tail"), "a", "r").groupBy("tail").agg(F.sum("a").alias("a"), F.sum("r").alias("r"))
        context = sums.select(F.expr(f"substring(tail, 1, {length})").alias("context"), "a", "r").groupBy("context").agg(F.sum("a").alias("ca"), F.sum("r").alias("cr"))
        level = sums.withColumn("context", F.expr(f"substring(tail, 1, {length})")).join(context, "context").select("tail", "a", "r", "ca", "cr")
        out = out.withColumn("tail", tail).join(level, "tail")
        for c in ("a", "r"):
            lower = probability[c] if length == 0 else F.col(f"p{c}")
            out = out.withColumn(f"p{c}", (F.col(c) + smooth * lower) / (F.col(f"c{c}") + smooth))
        out = out.select("gram", "pa", "pr")
    return out.select("gram", F.log(F.col("pa") / F.col("pr")).alias("ratio"))


def score_texts(texts: DataFrame, model: DataFrame, order: int = ORDER) -> DataFrame:
    """(text, score): mean of the model's ratio over the characters of each distinct text."""
    rows = texts.select("text").distinct()
    if model.count() <= SMALL:
        grams = _grams(rows, F.col("text"), ["text"], order).join(F.broadcast(model), "gram")
    else:
        salt = F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int")
        spread = model.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        grams = _grams(rows.withColumn("salt", salt), F.col("text"), ["text", "salt"], order).join(spread, ["gram", "salt"])
    return grams.groupBy("text").agg((F.sum(F.round(F.col("ratio") * 1e9).cast("long")) / (F.count("*") * 1e9)).alias("score"))


def filter_urls(df: DataFrame, id_col: str = "page_id", url_col: str = "url", rules=RULES, order: int = ORDER, smooth: float = SMOOTH) -> DataFrame:
    """(id, host, path, rule, verdict, score) per row: the longest fitting rule's verdict, or the language models'.

    The models learn from the URLs that a rule decides: characters of host and path of the allowed against the
    blocked. A URL's score is the log-likelihood difference per character. The threshold is half way between
    the mean scores of allowed and of blocked URLs, each host counting once for each verdict it has, so that neither
    the commoner verdict nor a large host moves it. Without both kinds the verdict is allow.

    Null URLs and those without ``://`` have empty host and path and are judged by the models. Repeated
    rows are judged each for itself. Other columns are not read. An empty table gives an empty table.
    """
    host, path = host_and_path(url_col)
    base = df.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    base = base.withColumn("fit", matching_rule(F.col("host"), F.col("path"), rules)).withColumn("text", F.concat("host", "path"))
    label = F.when(F.col("fit.verdict") == "allow", 1).when(F.col("fit.verdict") == "block", 0)
    texts = base.groupBy("text", "host", label.alias("label")).agg(F.count("*").alias("n"))
    texts = cut_lineage(texts)
    scores = cut_lineage(score_texts(texts, character_model(texts, order, smooth), order))
    sides = texts.where("label IS NOT NULL").join(scores, "text").groupBy("host", "label").agg(F.avg(F.round("score", 9)).alias("s"))
    mean = sides.groupBy("label").agg(F.avg(F.round("s", 9)).alias("s"))
    middle = mean.agg(F.when(F.count("*") == 2, F.round(F.avg("s"), 9)).alias("m")).scalar()
    judged = base.where("fit IS NULL").select("text").distinct().join(scores, "text")
    # Rules decide without the models; the rest are joined by their text.
    ruled = base.where("fit IS NOT NULL").select("id", "host", "path", F.col("fit.rule").alias("rule"), F.col("fit.verdict").alias("verdict"), F.lit(None).cast("double").alias("score"))
    rest = base.where("fit IS NULL").join(judged, "text", "left")
    verdict = F.when(F.coalesce(F.col("score") >= middle, F.lit(True)), "allow").otherwise("block")
    rest = rest.select("id", "host", "path", F.lit(None).cast("string").alias("rule"), verdict.alias("verdict"), "score")
    return ruled.union(rest).withColumnRenamed("id", id_col)
