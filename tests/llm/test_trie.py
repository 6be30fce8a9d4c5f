"""The prefix trie against brute force: hot prefixes, copies, odd rows, few and many heavy nodes, spilling queues."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from saltmarsh.llm import trie

KIND = "conv_id long, turn long, role string, text string"


def brute(rows):
    turns = defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            mark = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[c].append(((t is not None, t or 0), mark, (role, text)))
    own = {c: [x[2] for x in sorted(v)] for c, v in turns.items()}
    members, ends = defaultdict(set), defaultdict(list)
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq = own.get(c - c % 5, [])[:h] + mine[h:]
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].add(c)
        ends[tuple(seq)].append(c)
    kids = defaultdict(list)
    for s in members:
        if s:
            kids[s[:-1]].append(s)
    leaves, saved = {}, {}
    for s in sorted(members, key=len, reverse=True):
        leaves[s] = sum(leaves[k] for k in kids[s]) or 1
        saved[s] = (len(members[s]) - 1) * (len(s[-1][1].encode()) if s else 0) + sum(saved[k] for k in kids[s])
    return sorted(
        (min(m), len(s), min(members[s[:-1]]) if s else -1, len(m), len(kids[s]), leaves[s], saved[s], hashlib.sha256(",".join(map(str, sorted(ends[s]))).encode()).hexdigest())
        for s, m in members.items()
    )


def conversations():
    rng = random.Random(13)
    texts = ["a", "b", "hé", "", None, "long " * 50]
    rows = []
    for c in range(300):
        shape = rng.random()
        if shape < 0.3:  # copies of one conversation
            rows += [(c, t, "user", f"copy {t}") for t in range(6)]
        elif shape < 0.6:  # one hot first turn, many seconds
            rows += [(c, 0, "system", "hello"), (c, 1, "user", f"own {c}"), (c, 2, "user", rng.choice(texts))]
        elif shape < 0.9:
            rows += [(c, t, rng.choice(["user", None]), rng.choice(texts)) for t in range(rng.randrange(1, 12))]
    rows += [(c, t, "user", f"deep {t}") for c in (1000, 1005, 1010) for t in range(400)]
    rows += [(2001, None, "user", "x"), (2001, None, "user", "x"), (2001, 3, None, None), (2001, 3, "user", "y"), (2002, 1, "user", "z")]
    rows += [(None, 1, "user", "nobody"), (2003, 5, "a", "bc"), (2008, 5, "ab", "c"), (2**62, 0, "user", "big"), (3, 10**12, "user", "late")]
    rng.shuffle(rows)
    return rows


def run(spark, rows, **sizes):
    frame = spark.createDataFrame(rows, KIND).repartition(5).select("*", *[F.lit(1).alias(c) for c in ("p", "n", "k1", "depth", "mark", "one", "pid")])
    return sorted(tuple(-1 if v is None else v for v in r) for r in trie.prefix_trie(frame, **sizes).collect())


@pytest.mark.parametrize("sizes", [{}, {"heavy": 4, "queue": 3}, {"heavy": 40, "queue": 50}])
def test_matches_brute_force(spark, sizes):
    rows = conversations()
    assert run(spark, rows, **sizes) == brute(rows)


def test_empty_and_single(spark):
    assert run(spark, []) == []
    assert run(spark, [(None, 1, "user", "x")]) == []
    one = [(7, 0, "user", "x")]
    assert run(spark, one) == brute(one)


def test_queue_spills():
    rng = random.Random(1)
    entries = [((rng.randrange(-20, 0), rng.randrange(5), rng.randrange(-5, 5)), 1, k, 2 * k) for k in range(3000)]
    queue, want = trie.SpillingQueue(100), defaultdict(lambda: (0, 0, 0))
    for e in entries:
        queue.push(e)
        want[e[0]] = tuple(a + b for a, b in zip(want[e[0]], e[1:]))
    for key in sorted(want):
        assert queue.take(key) == want[key]
    assert queue.take((0, 0, 0)) == (0, 0, 0) and not queue.heap and not queue.heads
