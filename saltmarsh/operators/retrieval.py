"""Chunking, embedding and search over documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scale import attach, top_per_key
from ..session import cut_lineage

QUERY_BATCH = 4096  # query vectors sent to the tasks at a time
RRF_OFFSET = 60


# ---- chunks


def fixed_chunks(df: DataFrame, text: str, size: int, overlap: int) -> DataFrame:
    """Windows of ``size`` characters, each starting ``size - overlap`` after the one before."""
    starts = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)), F.lit(size - overlap))
    rows = df.select("*", F.posexplode(starts).alias("chunk_index", "_at"))
    return rows.withColumn("chunk", F.substr(F.col(text), F.col("_at"), F.lit(size))).drop("_at")


def section_chunks(df: DataFrame, text: str) -> DataFrame:
    """Sections, each starting at a '## ' heading line."""
    parts = F.filter(F.split(F.col(text), r"(?m)(?=^## )"), lambda s: s != "")
    return df.select("*", F.posexplode(parts).alias("chunk_index", "chunk"))


def split_recursively(text: str, size: int, overlap: int, separators: tuple[str, ...]) -> list[str]:
    """Pieces of at most ``size`` characters, cut at the coarsest separator that fits.

    Neighbouring pieces are packed together; a pack repeats up to ``overlap`` characters of
    whole pieces from the end of the pack before. For single texts; ``recursive_pieces`` is the same for columns.
    """
    sep, finer = "", ()
    for i, s in enumerate(separators):
        if s == "" or s in text:
            sep, finer = s, separators[i + 1 :]
            break
    out: list[str] = []
    pack: list[str] = []
    used = 0

    def flush() -> None:
        whole = sep.join(pack).strip()
        if whole:
            out.append(whole)

    for piece in text.split(sep) if sep else list(text):
        if len(piece) > size:
            if pack:
                flush()
                pack, used = [], 0
            out += split_recursively(piece, size, overlap, finer or ("",))
            continue
        grown = used + len(piece) + (len(sep) if pack else 0)
        if grown > size:
            flush()
            while pack and (used > overlap or used + len(piece) + len(sep) > size):
                used -= len(pack.pop(0)) + (len(sep) if pack else 0)
            grown = used + len(piece) + (len(sep) if pack else 0)
        pack.append(piece)
        used = grown
    if pack:
        flush()
    return out


SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _packed(pack: Column, sep: str) -> Column:
    """The pack as a chunk without white space around it; no chunk if nothing is left."""
    whole = F.btrim(F.array_join(pack, sep), F.lit(SPACE))
    return F.when(whole != "", F.array(whole)).otherwise(F.array().cast("array<string>"))


def _repeated(pack: Column, sep: str, limit: Column) -> Column:
    """(n, used): how many pieces from the end of the pack, joined, have at most ``limit`` characters."""

    def step(state, piece):
        grown = state["used"] + F.length(piece) + F.when(state["n"] > 0, len(sep)).otherwise(0)
        fits = state["open"] & (grown <= limit)
        return F.struct(
            F.when(fits, state["n"] + 1).otherwise(state["n"]).alias("n"), F.when(fits, grown).otherwise(state["used"]).alias("used"), fits.alias("open")
        )

    return F.aggregate(F.reverse(pack), F.struct(F.lit(0).alias("n"), F.lit(0).alias("used"), F.lit(True).alias("open")), step)


def recursive_pieces(text: Column, size: int, overlap: int, separators: tuple[str, ...]) -> Column:
    """Array of pieces of at most ``size`` characters, cut at the coarsest separator that fits; a fold in column functions.

    Neighbouring pieces are packed together; a pack repeats up to ``overlap`` characters of
    whole pieces from the end of the pack before. A piece that is too long closes the pack and is cut by the finer separators.
    """
    sep, finer = separators[0], separators[1:]
    pieces = F.split(text, r"\Q" + sep + r"\E", -1) if sep else F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))
    none = F.array().cast("array<string>")

    def after(out, at, n, used):
        return F.struct(out.alias("out"), at.cast("int").alias("at"), n.cast("int").alias("n"), used.cast("int").alias("used"))

    def folded(every):
        # the pack is the last n of the first ``at`` pieces, so a step moves numbers only
        def pack(state):
            return F.slice(every, state["at"] - state["n"] + 1, state["n"])

        def step(state, piece):
            size_of, at = F.length(piece), state["at"] + 1
            grown = state["used"] + size_of + F.when(state["n"] > 0, len(sep)).otherwise(0)
            # the kept end of the pack is worked out once and read from a one-element array
            kept = F.array(_repeated(pack(state), sep, F.least(F.lit(overlap), F.lit(size - len(sep)) - size_of)))
            opened = F.transform(
                kept,
                lambda k: after(F.concat(state["out"], _packed(pack(state), sep)), at, k["n"] + 1, k["used"] + size_of + F.when(k["n"] > 0, len(sep)).otherwise(0)),
            )
            fold = F.when(grown > size, F.get(opened, F.lit(0))).otherwise(after(state["out"], at, state["n"] + 1, grown))
            if not sep:  # single characters always fit
                return fold
            rest = recursive_pieces(piece, size, overlap, finer or ("",))
            return F.when(size_of > size, after(F.concat(state["out"], _packed(pack(state), sep), rest), at, F.lit(0), F.lit(0))).otherwise(fold)

        return F.aggregate(every, after(none, F.lit(0), F.lit(0), F.lit(0)), step, lambda s: F.concat(s["out"], _packed(pack(s), sep)))

    return F.get(F.transform(F.array(pieces), folded), F.lit(0))


def recursive_chunks(
    df: DataFrame, text: str, size: int = 300, overlap: int = 50, separators: tuple[str, ...] = ("\n\n", "\n", " ", "")
) -> DataFrame:
    """Recursive splitting in column functions. A null text gives no chunk; a ``size`` below one is refused."""
    if size < 1 or overlap < 0 or not separators:
        raise ValueError("size must be positive, overlap not negative, and there must be a separator")
    cut = recursive_pieces(F.coalesce(F.col(text), F.lit("")), size, overlap, tuple(separators))
    # the inner form would put a filter on the array below itself and so fold every text again
    return df.select("*", F.posexplode_outer(cut).alias("chunk_index", "chunk")).where("chunk_index IS NOT NULL")


def hash_vector(text: Column, dims: int) -> Column:
    """A fixed vector per text, from hashes of the text and the dimension (not semantic); normalise with ``unit``."""

    def cell(key, i):
        word = F.substr(F.md5(F.concat(key, (i + 1).cast("string"))), F.lit(1), F.lit(8))
        return F.conv(word, 16, 10).cast("double") / 4294967296.0 - 0.5

    # the text is hashed once and that hash repeated, so its length does not multiply with dims
    return F.transform(F.array_repeat(F.md5(text), dims), cell)


# ---- vector search


def label_centroids(vectors: DataFrame, label: str = "label", vector: str = "embedding") -> DataFrame:
    """Mean vector per label."""
    cells = vectors.select(label, F.posexplode(vector).alias("i", "x"))
    means = cells.groupBy(label, "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
    packed = means.groupBy(label).agg(F.array_sort(F.collect_list(F.struct("i", "m"))).alias("c"))
    return packed.select(F.col(label).alias("query_id"), F.transform("c", lambda c: c["m"]).alias("query"))


def similarity_search(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector: str = "embedding", batch: int = QUERY_BATCH) -> DataFrame:
    """The ``k`` nearest vectors per query by cosine; exact.

    Queries go to the tasks in batches of bounded size. Each task multiplies its Arrow batches
    with the query matrix and keeps its own best ``k`` per query, so only ``k`` rows per
    query and task are shuffled. More queries than one batch take further passes.
    """
    wanted = queries.select(F.col("query_id").cast("bigint").alias("query_id"), "query")
    count = wanted.count()
    found = None
    passes = max(1, -(-count // batch))
    for part in range(passes):
        some = wanted if passes == 1 else wanted.where(F.pmod(F.xxhash64("query_id"), F.lit(passes)) == part)
        rows = some.orderBy("query_id").collect()
        if not rows:
            continue
        ids = np.array([r["query_id"] for r in rows], dtype="int64")
        matrix = np.array([r["query"] for r in rows], dtype="float64")
        matrix /= np.linalg.norm(matrix, axis=1, keepdims=True)
        one = _search_pass(vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector).alias("v")), ids, matrix, k)
        found = one if found is None else found.unionByName(one)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, id bigint, score double, rank int")
    return top_per_key(found, ["query_id"], [F.col("score").desc(), F.col("id")], k)


def _search_pass(vectors: DataFrame, ids: np.ndarray, matrix: np.ndarray, k: int) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast((ids, matrix))

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        qids, q = shared.value
        kept_id = np.empty((len(qids), 0), dtype="int64")
        kept = np.empty((len(qids), 0), dtype="float64")
        for pdf in batches:
            x = np.stack(pdf["v"].to_numpy()).astype("float64")
            norm = np.linalg.norm(x, axis=1, keepdims=True)
            x = np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)
            scores = np.hstack([kept, np.round(q @ x.T, 9)])
            here = np.hstack([kept_id, np.tile(pdf["id"].to_numpy(), (len(qids), 1))])
            order = np.lexsort((here, -scores), axis=1)[:, :k]
            kept, kept_id = np.take_along_axis(scores, order, 1), np.take_along_axis(here, order, 1)
        n = kept.shape[1]
        yield pd.DataFrame({"query_id": np.repeat(qids, n), "id": kept_id.ravel(), "score": kept.ravel()})

    return vectors.mapInPandas(best, "query_id bigint, id bigint, score double")


# ---- keyword search


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), 0)


def bm25(docs: DataFrame, queries: dict[str, list[str]], k: int, text: str = "text", id_col: str = "doc_id", k1: float = 1.5, b: float = 0.75) -> DataFrame:
    """Top ``k`` documents per keyword query by BM25.

    Term counts are taken inside the row for the query words only, so documents are never
    shuffled; document frequencies and scores both come from those counts.
    """
    vocab = sorted({t for words in queries.values() for t in words})
    bag = tokens(F.col(text))
    rows = docs.select(F.col(id_col).alias("id"), bag.alias("_bag"))
    rows = rows.select("id", F.size("_bag").alias("_len"), F.filter("_bag", lambda t: t.isin(vocab)).alias("_hit"))

    def count_of(word):
        return F.size(F.filter("_hit", lambda t: t == word))

    # lengths and counts are small and kept, so the texts are read and cut into words once
    rows = cut_lineage(rows.select("id", "_len", *[count_of(w).alias(f"_tf{i}") for i, w in enumerate(vocab)]))
    rows = attach(rows, rows, n=F.count("*"), avg_len=F.avg("_len"), **{f"df{i}": F.count_if(F.col(f"_tf{i}") > 0) for i in range(len(vocab))})

    def weight(i):
        tf, df = F.col(f"_tf{i}"), F.col(f"_s.df{i}")
        idf = F.log(1 + (F.col("_s.n") - df + 0.5) / (df + 0.5))
        return idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("_len") / F.col("_s.avg_len")))

    at = {w: i for i, w in enumerate(vocab)}
    weights = rows.select("id", *[weight(i).alias(f"_w{i}") for i in range(len(vocab))])
    scored = weights.select("id", *[F.round(sum((F.col(f"_w{at[w]}") for w in words[1:]), F.col(f"_w{at[words[0]]}")), 9).alias(q) for q, words in queries.items()])
    long = scored.unpivot(["id"], list(queries), "query_id", "score").where("score > 0")
    return top_per_key(long, ["query_id"], [F.col("score").desc(), F.col("id")], k)


def fuse_ranks(a: DataFrame, b: DataFrame, k: int) -> DataFrame:
    """Reciprocal-rank sum of two ranked lists (query_id, id, rank)."""
    left = a.select("query_id", "id", F.col("rank").alias("rank_a"))
    right = b.select("query_id", "id", F.col("rank").alias("rank_b"))
    both = left.join(right, ["query_id", "id"], "full_outer")
    score = F.coalesce(1 / (RRF_OFFSET + F.col("rank_a")), F.lit(0.0)) + F.coalesce(1 / (RRF_OFFSET + F.col("rank_b")), F.lit(0.0))
    return top_per_key(both.withColumn("score", F.round(score, 12)), ["query_id"], [F.col("score").desc(), F.col("id")], k)


def expand_queries(terms: DataFrame, synonyms: DataFrame) -> DataFrame:
    """(query_id, term, is_added): the query's own words and their synonyms, each once."""
    own = terms.select("query_id", "term", F.lit(0).alias("added"))
    more = terms.join(synonyms, "term").select("query_id", F.col("synonym").alias("term"), F.lit(1).alias("added"))
    return own.unionByName(more).groupBy("query_id", "term").agg(F.min("added").alias("added"))


def context_block(hits: DataFrame, docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per query the found texts as one tagged context, and their sources in rank order.

    ``hits`` holds at most k rows per query, which bounds the group.
    """
    rows = hits.join(docs.select(F.col(id_col).alias("id"), "source", "text"), "id")
    packed = rows.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("rank", "source", "text"))).alias("h"))
    return packed.select(
        "query_id",
        F.array_join(F.transform("h", lambda h: F.concat(F.lit("[From "), h["source"], F.lit("]\n"), h["text"])), "\n\n").alias("context"),
        F.array_join(F.transform("h", lambda h: h["source"]), ",").alias("sources"),
    )


def token_overlap_metrics(pairs: DataFrame, keys: list[str], expected: str, actual: str) -> DataFrame:
    """ROUGE-1 recall and F1 and unigram precision from multiset token overlap."""
    def counts(c, name):
        return pairs.select(*keys, F.explode(tokens(F.col(c))).alias("token"), F.lit(name).alias("side"))

    both = counts(expected, "e").unionByName(counts(actual, "a"))
    per_token = both.groupBy(*keys, "token").agg(F.count_if(F.col("side") == "e").alias("e"), F.count_if(F.col("side") == "a").alias("a"))
    out = per_token.groupBy(*keys).agg(F.sum(F.least("e", "a")).alias("common"), F.sum("e").alias("n_e"), F.sum("a").alias("n_a"))
    recall, precision = F.try_divide("common", "n_e"), F.try_divide("common", "n_a")
    f1 = F.coalesce(F.try_divide(2 * recall * precision, recall + precision), F.lit(0.0))
    return out.select(*keys, recall.alias("recall"), precision.alias("precision"), f1.alias("f1"))
