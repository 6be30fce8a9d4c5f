"""Quality by compression: zstandard dictionaries of good and of bad text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.session import cut_lineage

SEGMENT = 1024  # bytes compressed at once, so that a dictionary counts for all of a long text
DICTIONARY = 112 << 10  # bytes of a trained dictionary
TRUST = 64  # bytes at which a text's own evidence counts as much as the share of label 1
SAMPLE_ROWS = 4000  # labelled rows of each label that a model is fitted on, at most
SAMPLE_CHARS = 8192  # code points taken of each of them, from a place set by the row's id


@dataclass(frozen=True)
class CompressionModel:
    """Two dictionaries and a logistic curve over the compressed-size difference."""

    good: bytes
    bad: bytes
    slope: float
    offset: float
    prior: float

    def measure(self):
        """A function from the bytes of a text to its difference and its length; the difference is its compressed size with the bad dictionary less
        that with the good one, per byte of text, summed over all segments."""
        packers = []
        for d in (self.good, self.bad):
            ready = zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_FULLDICT)
            ready.precompute_compress(level=3)
            packers.append(zstandard.ZstdCompressor(dict_data=ready, write_content_size=False, write_checksum=False, write_dict_id=False))

        def difference(raw: bytes) -> tuple[float, int]:
            good, bad = (sum(len(p.compress(raw[i : i + SEGMENT])) for i in range(0, len(raw), SEGMENT)) for p in packers)
            return (bad - good) / max(1, len(raw)), len(raw)

        return difference

    def probability(self, measured: np.ndarray) -> np.ndarray:
        """Of label 1, from rows of (difference, length); the shorter a text, the nearer to the share of label 1."""
        own = measured[:, 1] / (measured[:, 1] + TRUST)
        share = np.log(max(self.prior, 1e-6) / max(1 - self.prior, 1e-6))
        return 1 / (1 + np.exp(-(own * (self.slope * np.clip(measured[:, 0], -0.3, 0.3) + self.offset) + (1 - own) * share)))


def _dictionary(texts: list[bytes]) -> bytes:
    pieces = [t[i : i + SEGMENT] for t in texts for i in range(0, len(t), SEGMENT)]
    pieces = [p for p in pieces if len(p) >= 8]
    try:
        return zstandard.train_dictionary(DICTIONARY, pieces).as_bytes()
    except zstandard.ZstdError:  # too little text for a trained one
        try:
            size = max(256, sum(map(len, pieces)) // 8)
            return zstandard.train_dictionary(size, pieces).as_bytes()
        except zstandard.ZstdError:
            return b""


def _curve(x: np.ndarray, own: np.ndarray, share: float, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve ``own * (slope * x + offset) + (1 - own) * share`` by Newton's method, with a little ridge."""
    beta = np.zeros(2)
    design = np.column_stack([own * x, own])
    for _ in range(50):
        p = 1 / (1 + np.exp(-(design @ beta + (1 - own) * share)))
        slope = design.T @ (weight * (y - p)) - np.array([1e-3, 1e-3]) * beta
        curve = (design * (weight * p * (1 - p))[:, None]).T @ design + np.diag([1e-3, 1e-3])
        step = np.linalg.solve(curve, slope)
        beta = beta + np.clip(step, -50, 50)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def fit(labelled: DataFrame, text_col: str, label_col: str, order: Column, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> CompressionModel:
    """Fit on a bounded sample of ``labelled``: of each label the first ``rows`` rows by ``order`` (a hash), of each
    at most ``chars`` code points. Every other row trains the dictionaries; the rest calibrate, weighted to the
    labels' shares in all labelled rows.

    Rows with a null label or null text are not used. If a label has no row, or there is too little text for a
    dictionary, the model gives the share of label 1 (0.5 without any row) to every text.
    """
    rated = labelled.where(F.col(label_col).isin(0, 1) & F.col(text_col).isNotNull())
    shares = {r[0]: r[1] for r in rated.groupBy(label_col).count().collect()}
    good, bad = shares.get(1, 0), shares.get(0, 0)
    prior = good / (good + bad) if good + bad else 0.5
    here = F.lit(1) + F.pmod(F.xxhash64(order), F.greatest(F.lit(1), F.length(text_col) - chars + 1)).cast("int")
    piece = F.substring(F.col(text_col), here, F.lit(chars))
    sample = {}
    for c in (0, 1):
        picked = rated.where(F.col(label_col) == c).select(order.alias("o"), piece.alias("t")).orderBy("o", "t").limit(rows)
        sample[c] = [r[0].encode() for r in picked.select("t").collect()]
    flat = CompressionModel(b"", b"", 0.0, float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))), prior)
    if not (sample[0] and sample[1]):
        return flat
    dictionaries = {c: _dictionary(sample[c][::2]) for c in (0, 1)}
    if not (dictionaries[0] and dictionaries[1]):
        return flat
    measure = CompressionModel(dictionaries[1], dictionaries[0], 0, 0, prior).measure()
    check = {c: sample[c][1::2] or sample[c] for c in (0, 1)}
    measured = np.array([measure(t) for c in (0, 1) for t in check[c]])
    y = np.repeat([0.0, 1.0], [len(check[0]), len(check[1])])
    n = len(y)
    weight = np.where(y == 1, prior * n / len(check[1]), (1 - prior) * n / len(check[0]))
    own, share = measured[:, 1] / (measured[:, 1] + TRUST), float(np.log(prior / (1 - prior)))
    slope, offset = _curve(np.clip(measured[:, 0], -0.3, 0.3), own, share, y, weight)
    return CompressionModel(dictionaries[1], dictionaries[0], slope, offset, prior)


def _scorer(model: CompressionModel):
    ready = []  # the two dictionaries, prepared once in a task

    def run(text: str | None) -> float:
        raw = (text or "").encode()
        if not raw or not model.good:
            return model.prior
        if not ready:
            ready.append(model.measure())
        return float(model.probability(np.array([ready[0](raw)]))[0])

    return run


def score(df: DataFrame, model: CompressionModel, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``score``, the calibrated probability of label 1, for every row and whole text.

    Null and empty texts get the share of label 1 in the labelled rows. Repeated rows are scored
    each for itself. ``score`` must not be among ``keep``. Only texts go to the Python workers, a hundred at a time
    instead of Arrow's ten thousand, and only scores come back; a filter on ``score`` stays above, so that nothing is scored twice.
    """
    scorer = F.udf(_scorer(model), "double", useArrow=False).asNondeterministic()
    return df.select(*[F.col(f"`{c}`") for c in keep], scorer(F.col(text_col)).alias("score"))


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves no remainder by ``folds``; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == 0, F.lit(False))


def learning_rows(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, label) of labelled documents outside the held-out fold; rows with a null id are left out."""
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("label")).where("doc_id IS NOT NULL")
    marks = marks.where(~held_out("doc_id")).dropDuplicates(["doc_id", "label"])
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(marks, "doc_id")


def fit_quality(docs: DataFrame, labels: DataFrame, **options) -> CompressionModel:
    """A model of ``labels.quality`` from the rows outside the held-out fold.

    Which rows make the sample is settled on ids alone, so only their texts are read in full width.
    """
    rows = options.get("rows", SAMPLE_ROWS)
    known = docs.select("doc_id").where("doc_id IS NOT NULL").distinct()
    rated = labels.select("doc_id", "quality").where("quality IN (0, 1)").where(~held_out("doc_id")).dropDuplicates()
    rated = rated.join(known, "doc_id")
    shares = rated.groupBy("quality").count()
    picked = None
    for c in (0, 1):
        one = rated.where(F.col("quality") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
        picked = one if picked is None else picked.union(one)
    chosen = docs.sparkSession.createDataFrame(picked.withColumnsRenamed({"quality": "label"}).toArrow())  # 2 * rows at most
    sample = cut_lineage(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))  # texts are read once
    model = fit(sample, "text", "label", F.xxhash64("doc_id"), **options)
    counts = {r[0]: r[1] for r in shares.collect()}
    if not model.good or not counts.get(0) or not counts.get(1):
        return model
    prior = counts[1] / (counts[0] + counts[1])
    here = np.log(model.prior / (1 - model.prior))
    return CompressionModel(model.good, model.bad, model.slope, model.offset + float(np.log(prior / (1 - prior)) - here), prior)
