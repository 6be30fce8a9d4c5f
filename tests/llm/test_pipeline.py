"""The pipeline's stages, each against plain Python on its own input."""

import zlib
from collections import Counter

import corpus_pipeline as cp
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_documents import DOCS, shingles_of, words_of

from saltmarsh.llm import decontaminate, mixing

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output rows."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [docs.collect()]
    for k, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, SF)
        assert k == len(cp.STAGES) - 1 or out.columns == docs.columns
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        rows.append(docs.collect())
    return rows


def test_quality_keeps_rows_as_they_are(stages, spark):
    before, after = stages[:2]
    assert set(after) <= set(before) and 0 < len(after) <= len(before)
    good = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").collect()}
    kept, here = {r["doc_id"] for r in after}, {r["doc_id"] for r in before}
    assert len(kept & good) >= 0.9 * len(here & good)  # 160 labels are too few to reject much


def test_quality_rejects_bad_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r["doc_id"] for r in cp.keep_good(spark, docs, sf).select("doc_id").collect()}
    labels = docs.select("doc_id").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    good, bad = {r["doc_id"] for r in labels if r["quality"] == 1}, {r["doc_id"] for r in labels if r["quality"] == 0}
    assert len(kept & good) >= 0.95 * len(good) and len(bad - kept) >= 0.9 * len(bad)


def test_one_of_each_group_stays(stages):
    before, after = stages[1:3]
    sets = {r["doc_id"]: shingles_of(r["text"], 5) for r in before}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    assert sorted(r["doc_id"] for r in after) == [i for i in ids if root(i) == i]
    assert set(after) <= set(before)


def test_contaminated_documents_go(stages, spark):
    before, after = stages[2:4]
    docs = spark.createDataFrame(before, DOCS)
    found = decontaminate.benchmark_matches(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))
    gone = {r["doc_id"] for r in found.collect()}
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before if r["doc_id"] not in gone)


def test_mix_repeats_and_cuts(stages, spark):
    before, after = stages[3:5]
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(spark.createDataFrame(before, DOCS)).collect()}
    got = Counter()
    for r in after:
        got[r["doc_id"]] += len(words_of(r["text"]))
        assert r["n_chars"] == len(r["text"])
    assert dict(got) == {k: n for k, n in taken.items() if n}


def test_token_files_hold_the_mix(stages):
    tokenizers = pytest.importorskip("tokenizers")
    coder = tokenizers.Tokenizer.from_file(pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json"))
    before, after = stages[4:6]
    want = []
    for r in before:
        ids = np.array(coder.encode(r["text"], add_special_tokens=False).ids + [0], "<u4")
        want.append((r["doc_id"], len(ids), zlib.crc32(ids.tobytes())))
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in after) == sorted(want)
    start = 0
    for r in sorted(after, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]


def test_stages_on_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", None, None, 0), (2, " \n ", "en", "a", 3), (3, "word " * 50_000, "en", "a", None), (4, "one two", None, None, 7), (4, "one two", None, None, 7)]
    for docs in (spark.createDataFrame(rows, DOCS), spark.createDataFrame([], DOCS)):
        wide = docs.select("*", *[F.lit(1).alias(c) for c in ("size", "h", "s", "score", "kept", "component_id", "item_id")])
        for _, stage in cp.STAGES:
            assert stage(spark, wide, SF).count() <= 3 * docs.count()
