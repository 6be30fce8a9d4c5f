"""Word and shingle hashes of whole Arrow batches, computed on the UTF-8 bytes with numpy.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return, with A-Z lower-cased. Every word gets a 64-bit hash: the sum of a random value of each byte times a random
factor of its place in the word, from running sums, so the cost does not depend on how many words there are. Unlike powers of
one number, independent factors leave no pair of words that collide by their structure.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

STEP = 1 << 21  # bytes hashed at once
_U = np.uint64


@lru_cache(1)
def _tables() -> tuple:
    rng = np.random.default_rng(20240229)
    value = rng.integers(1, 2**63, 256, dtype=np.uint64) | _U(1)
    value[65:91] = value[97:123]
    space = np.zeros(256, bool)
    space[[32, 9, 10, 11, 12, 13]] = True
    return value, space, rng.integers(0, 2**64, STEP + 1, dtype=np.uint64) | _U(1)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> _U(30))
    h = h * _U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> _U(27))
    h = h * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and the offsets of each; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def _places(starts: np.ndarray, n: int) -> np.ndarray:
    """For each of ``n`` bytes its distance from the last of the ascending starts."""
    step = np.ones(n, np.int32)
    if len(starts):
        step[starts[0]] = 0
        step[: starts[0]] = 0
        step[starts[1:]] -= np.diff(starts).astype(np.int32)
    return np.cumsum(step, dtype=np.int32)


def word_hashes(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and for each text the place of its first word (one more at the end)."""
    value, space, factor = _tables()
    first = np.zeros(len(raw) + 1, bool)
    first[at] = True
    hashes, starts_at = [], []
    pos = 0
    while pos < len(raw):
        end = min(pos + STEP, len(raw))
        if end < len(raw):  # cut at white space or between texts
            cut = np.flatnonzero(space[raw[pos:end]] | first[pos + 1 : end + 1])
            if len(cut):
                end = pos + int(cut[-1]) + 1
        part = raw[pos:end]
        word = ~space[part]
        before = np.zeros(len(part), bool)
        before[1:] = word[:-1]
        start = np.flatnonzero(word & (~before | first[pos:end]))
        after = np.zeros(len(part), bool)
        after[:-1] = word[1:]
        stop = np.flatnonzero(word & (~after | first[pos + 1 : end + 1])) + 1
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(value[part] * factor[_places(start, len(part))], out=sums[1:])
        hashes.append(mix(sums[stop] - sums[start] + (stop - start).astype(np.uint64)))
        starts_at.append(start + pos)
        pos = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts_at), at)


def shingle_sets(texts: pa.Array, width: int, distinct: bool = True) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's word shingles; without ``distinct`` those of all of them as they stand.

    A text of fewer words has its whole word sequence as one shingle; one without words, none.
    """
    raw, at = text_buffers(texts)
    words, place = word_hashes(raw, at)
    n = len(words) - width + 1
    if n > 0:
        rolled = words[:n].copy()
        for j in range(1, width):
            rolled = mix(rolled * _U(0xC2B2AE3D27D4EB4F)) + words[j : j + n]
        rolled = mix(rolled)
    out = []
    for a, b in zip(place[:-1].tolist(), place[1:].tolist()):
        if b - a >= width:
            own = rolled[a : b - width + 1]
            out.append(np.unique(own) if distinct else own)
        elif b > a:
            h = words[a : a + 1].copy()
            for j in range(a + 1, b):
                h = mix(h * _U(0xC2B2AE3D27D4EB4F)) + words[j : j + 1]
            out.append(mix(h ^ _U(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def groups_of(texts: pa.Array, most_bytes: int = 8 << 20):
    """Row ranges of about ``most_bytes`` of text, so that a batch of long texts is worked through in pieces."""
    _, at = text_buffers(texts)
    a = 0
    while a < len(texts):
        b = max(a + 1, int(np.searchsorted(at, at[a] + most_bytes, side="right")) - 1)
        yield a, min(b, len(texts))
        a = b


@lru_cache(1)
def _plain() -> np.ndarray:
    return np.random.default_rng(20240301).integers(1, 2**63, 256, dtype=np.uint64) | _U(1)


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ascending spans of the bytes as they are."""
    _, _, factor = _tables()
    value = _plain()
    out = np.zeros(len(starts), np.uint64)
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(ends, starts[a] + STEP, side="right")))
        lo, hi = int(starts[a]), int(ends[b - 1])
        if hi - lo > STEP:  # one long span, in pieces
            h = _U(0)
            for p in range(lo, hi, STEP):
                part = raw[p : min(p + STEP, hi)]
                h = mix(np.array([h * _U(0xC2B2AE3D27D4EB4F) + (value[part] * factor[: len(part)]).sum(dtype=np.uint64)]))[0]
            out[a] = h
        else:
            s, e = starts[a:b] - lo, ends[a:b] - lo
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(value[raw[lo:hi]] * factor[_places(s, hi - lo)], out=sums[1:])
            out[a:b] = mix(sums[e] - sums[s] + (e - s).astype(np.uint64))
        a = b
    return out
