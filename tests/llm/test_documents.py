"""Operators on documents against brute force, with nulls, empty, long and repeated rows."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from saltmarsh.llm import decontaminate, fingerprints, graph, hashing, licenses, mixing, near_dups, quality, queries, token_counts, tokens

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


def shingles_of(text, width):
    w = words_of(text)
    return {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def odd_documents():
    rng = random.Random(5)
    vocabulary = ["w%d" % k for k in range(400)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    rows, base = [], prose(120)
    for k in range(230):  # a large group of near copies, some far
        w = base.split()
        for _ in range(rng.choice([0, 1, 1, 2, 3, 6, 12])):
            w[rng.randrange(len(w))] = "x%d" % rng.randrange(10**6)
        rows.append((k, " ".join(w), "en", "a", 1))
    rows += [(1000 + k, base.upper().replace(" ", "\t"), "en", "a", 1) for k in range(20)]  # exact after lower-casing
    rows += [(2000 + k, prose(rng.choice([1, 2, 3, 30])), "de", "b", None) for k in range(60)]
    rows += [(3000, None, None, None, None), (3001, "", "en", None, 0), (3002, " \n\t ", "en", "", 0), (None, base, "en", "a", 1), (3003, prose(1), None, "c", 1)]
    rows += [(3004, prose(40_000), "en", "c", 1), (3005, "é" * 5000 + " ÄÖ ß\x00 x", "de", "c", 1), (3006, "same words here now", "en", "c", 1), (3006, "same words here now", "en", "c", 1)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    rows = odd_documents()
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    clash = [F.lit(1).alias(c) for c in ("id", "n", "mark", "bands", "size", "h", "s", "slot", "score", "component_id", "word", "key")]
    return rows, frame.select("*", *clash), frame


def test_word_hashes_cut_anywhere(monkeypatch):
    texts = pa.array(["A b  c\td e", "", None, "a B c d\n e", "x" * 300 + " y", "é à è ü"])
    want = [s.tolist() for s in hashing.shingle_sets(texts, 3)]
    whole, place = hashing.word_hashes(*hashing.text_buffers(texts))
    monkeypatch.setattr(hashing, "STEP", 16)
    hashing._tables.cache_clear()
    again, at = hashing.word_hashes(*hashing.text_buffers(texts.slice(0, 4)))
    hashing._tables.cache_clear()
    assert again.tolist() == whole[: len(again)].tolist() and at.tolist() == place[:5].tolist()
    assert want[0] == want[3] and want[1] == want[2] == []


def test_structured_words_do_not_collide(spark):
    """The Thue-Morse word and its mirror collide under any polynomial modulo a power of two."""
    bits = [bin(k).count("1") % 2 for k in range(2048)]
    one, two = ("".join(x[b] for b in bits) for x in ("ab", "ba"))
    raw, at = hashing.text_buffers(pa.array([one, two]))
    assert len(set(hashing.word_hashes(raw, at)[0].tolist())) == 2
    assert len(set(hashing.span_hashes(raw, at[:-1], at[1:]).tolist())) == 2
    frame = spark.createDataFrame([(1, one, "en", "a", 1), (2, two, "en", "a", 1)], DOCS).coalesce(1)
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in near_dups.near_duplicates(frame).collect()} == {(1, 1, True), (2, 2, True)}
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    want = [len(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) + 1 for t in (one, two)]
    got = sorted(tokens.token_files(frame, path).collect())
    assert [r["n_tokens"] for r in got] == want and got[0]["ids_crc32"] != got[1]["ids_crc32"]
    assert len({r["fingerprint"] for r in fingerprints.fingerprints(frame).collect()}) == 2


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(100, 160)] + [(1, k) for k in range(2, 40)] + [(7, 7), (None, 3), (50, 60), (60, 50)]
    got = {r["node"]: r["component"] for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 100 for k in range(100, 161)}, **{k: 1 for k in range(1, 40)}, 50: 50, 60: 50}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_match_all_pairs(odd, width, percent):
    rows, clash, _ = odd
    got = near_dups.near_duplicates(clash, width=width, percent=percent).collect()
    sets = defaultdict(set)
    for i, t, *_ in rows:
        if i is not None:
            sets[i] |= {frozenset(shingles_of(t, width))}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    one = {i: next(iter(s)) for i, s in sets.items()}
    ids = sorted(one)
    for a in ids:
        for b in ids:
            if a < b and one[a] and one[b]:
                both = len(one[a] & one[b])
                if 100 * both >= percent * (len(one[a]) + len(one[b]) - both):
                    x, y = root(a), root(b)
                    parent[max(x, y)] = min(x, y)
    want = sorted((i, len(one[i]), root(i), root(i) == i) for i, *_ in rows if i is not None)
    assert sorted(tuple(r) for r in got if r["doc_id"] is not None) == want
    none = [r for r in got if r["doc_id"] is None]
    assert len(none) == 1 and not none[0]["kept"]
    assert len({w[2] for w in want}) > 80


def test_near_duplicates_of_nothing(spark):
    out = near_dups.near_duplicates(spark.createDataFrame([], DOCS))
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"] and out.count() == 0


def test_neighbourhoods_do_not_follow_chains(spark):
    chain = [(k, 5, 10_000 + k + j) for k in range(3000) for j in (0, 1)]
    got = near_dups._neighbourhoods(spark.createDataFrame(chain, "id long, n long, key long"))
    sizes = [tuple(r) for r in got.groupBy("grp").agg(F.count("*"), F.max("members"), F.max("blocks")).collect()]
    assert len(sizes) == 2999 and {r[1:] for r in sizes} == {(2, 2, 1)}
    assert near_dups._first_sides(got).count() == 2 * 2999
    hot = [(k, 5, key) for k in range(1000) for key in (1, 2 + k % 3)] + [(5000 + k, 1 << 19, 9) for k in range(6)]
    got = near_dups._neighbourhoods(spark.createDataFrame(hot, "id long, n long, key long"))
    sizes = {tuple(r) for r in got.groupBy("grp", "members", "blocks").agg(F.count("*")).collect()}
    assert sizes == {(0, 1000, 11, 1000), (5000, 6, 3, 6)}  # bands inside another neighbourhood add none


def test_circulant_signature_is_the_definition():
    rng = np.random.default_rng(3)
    s = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    ranks = np.random.default_rng(7).permutation(near_dups.SLOTS)
    slot = ((s * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(43)).astype(np.int64)
    want = [int(ranks[(slot + k) % near_dups.SLOTS].min()) for k in range(24)]
    assert near_dups.signature(s, 24).tolist() == want


def oracle(rows, key):
    con = duckdb.connect()
    con.register("documents", pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate([("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string())])}))
    return con.execute(queries.ORACLE[key]).fetchall()


def test_mix_matches_sql(odd):
    rows, clash, _ = odd
    got = mixing.mix(clash).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, oracle(rows, "op4_mix_sources")))
    by_source = defaultdict(int)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by_source[(r["source_size"], r["target"])] += r["taken"]
    for (_, target), taken in by_source.items():
        assert target - 3 <= taken <= target


def test_mixed_documents_hold_the_words_taken(odd):
    _, clash, _ = odd
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(clash).collect()}
    out = mixing.mixed_documents(clash)
    assert out.columns == clash.columns
    got = Counter()
    for r in out.select("doc_id", "text").collect():
        got[r["doc_id"]] += len(words_of(r["text"]))
    assert {k: n for k, n in got.items() if k != 3006} == {k: n for k, n in taken.items() if n and k != 3006}
    assert mixing.mixed_documents(clash.limit(0)).count() == 0 and mixing.mix(clash.limit(0)).count() == 0


def path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_token_files_round_trip(odd, spark):
    from tokenizers import Tokenizer

    rows, clash, _ = odd
    coder = Tokenizer.from_file(path())
    ids = {}
    want, start = [], 0
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    for i, t, *_ in order:
        own = coder.encode(t or "", add_special_tokens=False).ids + [0]
        ids[i] = own
        want.append((i, start, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
        start += len(own)
    assert sorted(map(str, (tuple(r) for r in tokens.token_files(clash, path()).collect()))) == sorted(map(str, want))
    assert tokens.token_files(clash.limit(0), path()).count() == 0


def test_pieces_are_encoded_as_whole_texts():
    coder = tokens.Encoder(path())
    assert coder.cuts
    rng = random.Random(1)
    alphabet = ["a", "the", "'s", " ", "  ", "\n", "\t", "é", "ñ", "12", "%", " ", "　", "漢", "<|endoftext|>", "\r", "\x1c", "."]
    texts = [None, "", " ", "x "] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(3000)]
    want = [e.ids for e in coder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for _ in range(2):  # with an empty and with a full memo
        ids, place = coder.encode(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(place[:-1], place[1:])] == want


def test_code_lengths_are_optimal_within_the_limit():
    rng = np.random.default_rng(2)
    counts = (rng.pareto(0.7, 500) * 10).astype(np.int64)
    lengths = tokens.code_lengths(counts, 30)
    heap = [(int(c), k, (k,)) for k, c in enumerate(counts) if c]
    cost = 0
    heapq.heapify(heap)
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        cost += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], a[1], ()))
    assert int((lengths * counts).sum()) == cost
    short = tokens.code_lengths(counts, 9)
    assert short.max() <= 9 and sum(2.0 ** -int(n) for n in short if n) <= 1
    assert tokens.code_lengths(np.array([0, 5])).tolist() == [0, 1]


def test_pack_and_unpack_many_blocks():
    rng = np.random.default_rng(4)
    sizes = [1, 0, 2000, 512, 513, 1, 7000]
    ids = rng.zipf(1.3, sum(sizes)) % 3000
    place = np.append(0, np.cumsum(sizes))
    lengths = tokens.code_lengths(np.bincount(ids))
    payload, points = tokens.pack(ids, place, tokens.canonical_codes(lengths), lengths)
    out, at = tokens.unpack(payload, points, np.array(sizes), tokens.decoding_table(lengths))
    assert (out == ids).all() and (at == place).all()


def test_fingerprints_against_texts(odd):
    rows, clash, _ = odd
    plain = [r for r in rows if r[0] not in (3006, None)]
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(clash.where("doc_id <> 3006")).collect()}
    order = sorted(plain)
    assert set(got) == {r[0] for r in plain}
    errors = []
    for (i, t, *_), (_, nxt, *_) in zip(order, order[1:] + order[:1]):
        t, nxt, r = t or "", nxt or "", got[i]
        half = len(t) // 2
        changed = t[: len(t) - half] + nxt[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        for other, near in ((changed, r["near_edited"]), (nxt, r["near_next"])):
            a, b = shingles_of(t, 5), shingles_of(other, 5)
            true = len(a & b) / len(a | b) if a | b else 1.0
            errors.append(abs(near - true))
    assert max(errors) < 0.15 and sum(errors) / len(errors) < 0.03
    assert got[1000]["fingerprint"] == got[1001]["fingerprint"] == got[next(i for i, t, *_ in rows if shingles_of(t, 5) == shingles_of(rows[230][1], 5))]["fingerprint"]
    assert got[3000]["fingerprint"] == "" and fingerprints.fingerprints(clash.limit(0)).count() == 0
    alone = fingerprints.fingerprints(clash.where("doc_id = 5")).collect()
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
    assert fingerprints.fingerprints(clash.where("doc_id = 3006 OR doc_id IS NULL")).count() == 3


def test_densified_bins_and_packing():
    s = np.array([5, 9], np.uint64)
    v = fingerprints.sketch(s)
    assert len(v) == fingerprints.BINS and (fingerprints.unpacked(fingerprints.packed(v)) == v).all()
    assert fingerprints.likeness(v, fingerprints.sketch(s)) == 1.0 and fingerprints.likeness(None, v) == 0.0 and fingerprints.likeness(None, None) == 1.0


def test_contaminated_documents_match_all_windows(spark):
    rng = random.Random(9)
    vocabulary = ["q%d" % k for k in range(300)]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(8, 60)))) for k in range(30)] + [(40, None), (41, "too short"), (None, "a b c d e f g")]
    docs = []
    for k in range(200):
        w = [rng.choice(vocabulary) for _ in range(rng.randrange(5, 200))]
        if k % 4 == 0:
            own = items[rng.randrange(30)][1].split()
            for _ in range(k % 3):
                own[rng.choice([0, 1, len(own) - 1, len(own) - 2, rng.randrange(len(own))])] = "changed%d" % k
            at = rng.randrange(len(w))
            w[at:at] = own
        docs.append((k, " ".join(w).upper() + ".", "en", "s", 1))
    docs += [(500, None, None, None, None), (501, "", None, None, 0), (None, items[0][1], None, None, 1), (502, items[0][1], "en", "s", 1), (502, items[0][1], "en", "s", 1), (503, (items[1][1] + " ") * 40, "en", "s", 1)]
    frame = spark.createDataFrame(docs, DOCS).withColumn("item_id", F.lit(7)).withColumn("start", F.lit(1))
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = {(r["doc_id"], r["item_id"]): (r["similarity"], r["start"]) for r in decontaminate.benchmark_matches(frame, table).collect()}

    def norm(t):
        return re.sub(r"[\W_]+", " ", (t or "").lower()).split()

    def sh(w):
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    own = {i: norm(t) for i, t in items if i is not None and len(norm(t)) >= 5}
    df = Counter(s for w in own.values() for s in sh(w))
    want = {}
    for d, t, *_ in docs:
        w = norm(t)
        for i, iw in own.items():
            for start in range(len(w)):
                win, s = sh(w[start : start + len(iw)]), sh(iw)
                if win & s:
                    aligned = any(w[p : p + 5] == iw[q : q + 5] and max(0, p - q) == start for p in range(len(w) - 4) for q in (p - start, *(range(p + 1) if start == 0 else ())) if 0 <= q <= len(iw) - 5)
                    both = sum(1 + math.log(len(own) / df[x]) for x in win & s)
                    union = sum(1 + math.log(len(own) / df[x]) for x in s) + len(win - s) * (1 + math.log(len(own)))
                    j = round(both / union, 9)
                    if aligned and j >= 0.8:
                        want[(d, i)] = max(want.get((d, i), (0, 0)), (j, -start))
    assert got == {k: (j, -s) for k, (j, s) in want.items()}
    assert (502, 0) in got and (None, 0) in got and (503, 1) in got and any(j < 1 for j, _ in got.values())
    clean = decontaminate.clean_documents(frame, table)
    assert clean.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(str(d[0]) for d in docs if d[0] is None or d[0] not in {k[0] for k in got})
    assert decontaminate.benchmark_matches(frame.limit(0), table).count() == 0
    assert decontaminate.benchmark_matches(frame, table.limit(0)).count() == 0


def test_blocks_find_everything_within_the_radius(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a
        for bit in rng.sample(range(64), rng.randrange(0, 21)):
            b ^= 1 << bit
        rows.append(tuple(x - (1 << 64) if x >> 63 else x for x in (a, b)))
    f = spark.createDataFrame(rows, "a long, b long")
    blocks = lambda c: decontaminate.blocks(F.col(c), 20)
    assert f.where(F.arrays_overlap(blocks("a"), blocks("b"))).count() == 300


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    scored = queries.op9_quality(spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    hits = scored.join(labels, "doc_id").groupBy("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("right"), F.count("*").alias("n")).collect()
    assert {r["held_out"] for r in hits} == {True, False} and all(r["right"] > 0.95 for r in hits)
    want = {k: zlib.crc32(str(k).encode()) % 5 == 0 for k in range(50)}
    assert {r["doc_id"]: r["held_out"] for r in scored.where("doc_id < 50").collect()}.items() <= want.items()


def test_quality_of_odd_rows(odd, spark):
    _, clash, plain = odd
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(60)] + [(None, 1, 0), (3000, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit_quality(plain, labels)
    out = quality.score(plain, model, "text", ["doc_id", "lang"])
    assert out.columns == ["doc_id", "lang", "score"] and out.where("score BETWEEN 0 AND 1").count() == plain.count()
    assert {r["score"] for r in out.where("doc_id IN (3000, 3001)").collect()} == {model.prior}
    flat = quality.fit_quality(plain, labels.limit(0))
    assert {r["score"] for r in quality.score(plain, flat, "text", []).collect()} == {0.5}
    assert quality.score(plain.limit(0), model, "text", ["doc_id"]).count() == 0


def test_scoring_sends_texts_a_few_at_a_time_and_once(spark):
    texts = [f"good plain words about rivers and number {k} of many" for k in range(200)], [f"$$$ buy now {k} !!! click >>> here" for k in range(200)]
    rows = [(2 * k + c, t, "a") for c in (0, 1) for k, t in enumerate(texts[c])] + [(900, None, "b"), (901, "", None), (None, texts[0][0], "a"), (0, texts[0][0] * 50, "a")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(400)], "doc_id long, quality int")
    model = quality.fit_quality(docs, labels)
    assert model.good and model.bad
    scored = quality.score(docs, model, "text", docs.columns)
    measure = model.measure()
    want = [(*r, model.probability(np.array([measure(r[1].encode())]))[0] if r[1] else model.prior) for r in rows]
    assert sorted(map(tuple, scored.collect()), key=repr) == sorted(want, key=repr)
    plan = scored.where("score >= 0.3")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BatchEvalPython") == 1 and "MapInArrow" not in plan  # whole rows in Arrow batches of 10,000 before


def test_ids_are_counted_in_little_memory():
    import tracemalloc

    ids = np.random.default_rng(3).integers(0, 50_000, 3_000_000).astype("<u2")
    batch = pa.RecordBatch.from_arrays([pa.array([ids[:7].tobytes(), ids[7:].tobytes(), b""], pa.binary())], ["ids"])
    tracemalloc.start()
    counted = next(tokens._count("<u2")([batch, batch.slice(0, 1)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = np.bincount(np.append(ids, ids[:7]))
    assert dict(zip(*(c.to_pylist() for c in counted.columns))) == {int(k): int(want[k]) for k in np.flatnonzero(want)}
    assert peak < 3 * ids.nbytes  # four times the ids and more before


def test_counts_follow_edits(odd, spark):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(path())
    rng = random.Random(11)
    bits = ["", " ", "  x", "a b c", "don't", "\n", " é", "long words here and there " * 20]
    rows = []
    for i, t, *_ in odd_documents()[::7]:
        edits = [(k, rng.randrange(0, 2 * len(t or "") + 3), rng.choice([0, 1, 5, 300]), rng.choice(bits)) for k in range(rng.randrange(0, 9))]
        rows.append((i, t, edits))
    rows += [(7000, "one two", None), (7001, "one two", [None, (1, None, None, None), (0, -5, -2, "x")])]
    kind = "doc_id long, text string, log array<struct<seq:long,at:long,delete:long,insert:string>>"
    got = token_counts.edited_counts(spark.createDataFrame(rows, kind), F.col("log"), path()).collect()
    want = []
    for i, t, edits in rows:
        now = t or ""
        for _, at, delete, insert in sorted((e for e in edits or [] if e), key=lambda e: e[0]):
            at = max(0, min(at or 0, len(now)))
            now = now[:at] + (insert or "") + now[at + max(0, delete or 0) :]
        count = [len(coder.encode(x, add_special_tokens=False).ids) for x in (t or "", now)]
        want.append((i, *count, len(now)))
    assert sorted(map(str, (tuple(r)[:4] for r in got))) == sorted(map(str, want))
    long = next(r for r in got if r["edited_chars"] > 100_000) if any(r["edited_chars"] > 100_000 for r in got) else None
    assert long is None or long["recoded_chars"] < long["edited_chars"]
    log = spark.createDataFrame([(1, 0, 0, 1, "z"), (1, 1, 0, 0, "y")], "doc_id long, seq long, at long, delete long, insert string")
    assert {r["doc_id"]: len(r["edits"] or []) for r in token_counts.with_edits(spark.range(3).withColumnRenamed("id", "doc_id"), log).collect()} == {0: 0, 1: 2, 2: 0}


def test_licences_of_files_and_folders(spark):
    apache, mit = "Licensed under the Apache License, Version 2.0.", "Released under the MIT License."
    rows = [
        (1, "a/LICENSE", "words\n" + apache), (2, "a/b/c/x", "nothing of the kind"), (3, "a/b/LICENSE", "RELEASED UNDER THE MIT LICENSE"), (4, "a/b/c/y", None), (5, "a/z", ""),
        (6, "q/z", "plain"), (7, None, mit), (8, None, "plain"), (9, "top", "text " * 3000 + apache + " more" * 3000), (10, "a/b/c/x", "nothing of the kind"), (11, "LICENSE/x", "the of and"),
    ]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string").withColumn("own", F.lit(1)).withColumn("folder", F.lit(2))
    got = {r["doc_id"]: (r["own"], r["license"], r["inherited_from"]) for r in licenses.scan_licenses(files).collect()}
    assert got == {
        1: ("Apache-2.0", "Apache-2.0", None), 2: (None, "MIT", "a/b"), 3: ("MIT", "MIT", None), 4: (None, "MIT", "a/b"), 5: (None, "Apache-2.0", "a"),
        6: (None, None, None), 7: ("MIT", "MIT", None), 8: (None, None, None), 9: ("Apache-2.0", "Apache-2.0", None), 10: (None, "MIT", "a/b"), 11: (None, None, None),
    }
    assert licenses.scan_licenses(files.limit(0)).count() == 0


def plain_licence(text, templates, idf, rest, cosine, close):
    """Best licence by cosines of all windows, one by one."""
    def vector(words):
        return {w: n * idf.get(w, rest) for w, n in Counter(words).items()}

    def product(a, b):
        return sum(x * b.get(w, 0.0) for w, x in a.items()) / math.sqrt(sum(x * x for x in a.values()) * sum(x * x for x in b.values()))

    words, found = re.findall("[a-z0-9]+", text.lower()), []
    for name, template in templates:
        wanted = re.findall("[a-z0-9]+", template.lower())
        n = min(len(wanted), len(words))
        found += [(round(product(vector(words[k : k + n]), vector(wanted)), 9), name, -k, n) for k in range(len(words) - n + 1)] if n else []
    found = [f for f in found if f[0] >= cosine]
    if not found:
        return None, None, False
    top, name, k, n = max((f for f in found), key=lambda f: (f[0], f[1], f[2]))
    rivals = [c for c, other, j, m in found if other != name and -j < -k + n and -j + m > -k]
    return (None, None, True) if rivals and top - max(rivals) < close else (name, top, False)


def test_licences_equal_plain_cosines_of_all_windows(spark):
    templates = (("A", "one two three four five"), ("B", "one two three four six seven"), ("C", "two two nine"), ("C", "nine ten one two three four five six seven eight one two"), ("D", "six six six"))
    rng = random.Random(11)
    vocabulary = "one two three four five six seven eight nine ten x y z".split()
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 2, 5, 9, 30, 200]))) for _ in range(150)]
    texts += [t for _, t in templates] + ["x " + t + "; y" for _, t in templates] + ["one two three four", "SIX six, six " * 40]
    n = len(texts)
    own = set(re.findall("[a-z]+", " ".join(t for _, t in templates)))
    idf = {w: 1 + math.log((1 + n) / (1 + sum(w in re.findall("[a-z]+", t.lower()) for t in texts))) for w in own}
    for cosine, close in ((0.75, 0.003), (0.4, 0.05)):
        files = spark.createDataFrame([(k, None, t) for k, t in enumerate(texts)], "doc_id long, path string, text string").repartition(3)
        got = {r["doc_id"]: (r["own"], r["cosine"], r["contested"]) for r in licenses.scan_licenses(files, templates=templates, cosine=cosine, close=close).collect()}
        want = {k: plain_licence(t, templates, idf, max(idf.values()), cosine, close) for k, t in enumerate(texts)}
        assert {k: (a, c) for k, (a, _, c) in got.items()} == {k: (a, c) for k, (a, _, c) in want.items()}
        assert all(v[1] is None or abs(v[1] - want[k][1]) < 1e-8 for k, v in got.items())
        assert len({v[0] for v in got.values()}) > 3


def test_licence_versions_and_licence_files(spark):
    gpl2 = next(t for n, t in licenses.TEMPLATES if n == "GPL-2.0" and t.startswith("This program"))
    mit = max((t for n, t in licenses.TEMPLATES if n == "MIT"), key=len)
    bsd2, bsd3 = (next(t for n, t in licenses.TEMPLATES if n == name) for name in ("BSD-2-Clause", "BSD-3-Clause"))
    gnu = "This work is licensed under the GNU %sGeneral Public License, version %s."
    prose = "plain words that stand before and after the notice of a file " * 30
    texts = {
        "GPL-2.0": gpl2.replace("This program", "Frobnicator"), "LGPL-2.1": prose + gnu % ("Lesser ", "2.1") + prose, "LGPL-3.0": gnu % ("Lesser ", "3"), "GPL-3.0": gnu % ("", "3"),
        "AGPL-3.0": prose + gnu % ("Affero ", "3"), "MIT": "Copyright (c) 2020 Somebody\n\n" + mit.replace('"', "\u201c").replace(". ", ".\n * "), "BSD-2-Clause": prose + bsd2, "BSD-3-Clause": "Copyright\n" + bsd3.lower(),
        "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0", "CC-BY-4.0": "Licensed under CC BY 4.0",
    }
    rows = [(k, f"p{k}/{('LICENSE.md', 'COPYING', 'licence.txt')[k % 3]}", t) for k, t in enumerate(texts.values())]
    rows += [(100 + k, f"p{k}/src/deep/x.py", "plain") for k in range(len(texts))] + [(200, "p0/LICENSES_OF_OTHERS/x", "plain"), (201, "q/NOLICENSE", bsd3), (202, "q/y", bsd3[:130])]
    files = spark.createDataFrame(rows, "doc_id long, path string, text string")
    got = {r["doc_id"]: (r["own"], r["license"]) for r in licenses.scan_licenses(files).collect()}
    for k, name in enumerate(texts):
        assert got[k] == (name, name) and got[100 + k] == (None, name), (name, got[k], got[100 + k])
    assert got[201] == ("BSD-3-Clause",) * 2 and got[202] == (None, None) and got[200] == (None, "GPL-2.0")
