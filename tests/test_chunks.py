"""Recursive chunks against a plain splitter."""

import random

import pytest

from saltmarsh.operators import retrieval as rt
from saltmarsh.plans import QUERIES

SEPARATORS = ("\n\n", "\n", " ", "")


def plain(text, size, overlap, separators=SEPARATORS):
    """Cut at the first separator that occurs, pack neighbours, repeat the end of a pack."""
    at = next((i for i, s in enumerate(separators) if s in text), 0)
    sep, out, pack = separators[at], [], []

    def joined():
        return sep.join(pack)

    for piece in text.split(sep) if sep else list(text):
        if len(piece) > size:
            out += [joined().strip(), *plain(piece, size, overlap, separators[at + 1 :])]
            pack = []
            continue
        if pack and len(joined()) + len(sep) + len(piece) > size:
            out.append(joined().strip())
            while pack and (len(joined()) > overlap or len(joined()) + len(sep) + len(piece) > size):
                pack.pop(0)
        pack.append(piece)
    return [c for c in [*out, joined().strip()] if c]


@pytest.mark.parametrize("size,overlap", [(30, 8), (12, 0), (7, 20), (1, 0)])
def test_recursive_chunks_match_a_plain_splitter(spark, size, overlap):
    rng = random.Random(size)
    bits = ["a", "bc", "défg", "\U0001f600", " ", " ", "\n", "\n\n", "\t", "　", "x" * 25, "\\E", ".", "$1"]
    texts = ["", " ", "\n\n\n", "a" * 40, None] + ["".join(rng.choice(bits) for _ in range(rng.randrange(1, 90))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {}
    for r in rt.recursive_chunks(df, "t", size, overlap).orderBy("i", "chunk_index").collect():
        got.setdefault(r["i"], []).append(r["chunk"])
    assert got == {i: c for i, t in enumerate(texts) if (c := plain(t or "", size, overlap))}
    assert got == {i: c for i, t in enumerate(texts) if (c := rt.split_recursively(t or "", size, overlap, SEPARATORS))}


def test_recursive_chunks_need_no_python(spark, small):
    plan = QUERIES["chunk_recursive"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
