"""Token ids of documents in Huffman-coded files."""

from __future__ import annotations

import uuid
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from saltmarsh.llm.hashing import groups_of, span_hashes, text_buffers
from saltmarsh.session import scratch_path

BLOCK = 512  # ids between two checkpoints
MOST_BITS = 18  # longest code; the decoding table has 2 ** MOST_BITS entries
MEMO = 1 << 21  # places of the memo of encoded pieces
PIECE = 1 << 20  # ids read at once, if a single text has not more
PART = 1 << 18  # bytes of text encoded, and ids counted or packed, at once, if a single text is not longer
END = 0  # id appended to each document


class Encoder:
    """Ids of whole texts by the tokenizers library, with a memo of pieces.

    Where the tokenizer splits by the byte-level pattern, no token spans the place before a space
    that a character other than white space follows. Texts are cut there, and a piece that was encoded before is
    looked up by its 64-bit hash and length. Texts with other spaces, and other tokenizers, are encoded whole.
    """

    def __init__(self, path: str):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            conf = json.load(f)
        pre = conf.get("pre_tokenizer") or {}
        added = conf.get("added_tokens") or []
        plain = all(" " not in a["content"] and not (a["lstrip"] or a["rstrip"] or a["single_word"]) for a in added)
        self.cuts = pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not conf.get("normalizer") and plain
        self.type = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.bare = np.zeros(256, bool)  # bytes that may follow a space at a cut
        self.bare[33:128] = True
        self.bare[[0xC3, *range(0xC4, 0xE1), *range(0xE4, 0xF5)]] = True
        self._clear()

    def _clear(self):
        self.keys = np.zeros(MEMO, np.uint64)
        self.slot = np.zeros(MEMO, np.int32)
        self.start, self.length, self.size = np.zeros(MEMO, np.int64), np.zeros(MEMO, np.int32), np.zeros(MEMO, np.int32)
        self.used = 0
        self.pool = np.zeros(1 << 20, self.type)
        self.fill = 0

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: np.ndarray, texts: list[str], sizes: list[int]) -> None:
        sizes = np.array(sizes, np.int32)
        for a in range(0, len(texts), 4096):
            ids = self._whole(texts[a : a + 4096])
            length = np.fromiter(map(len, ids), np.int32, len(ids))
            total = int(length.sum())
            while self.fill + total > len(self.pool):
                self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), self.type)])
            self.pool[self.fill : self.fill + total] = np.fromiter(chain.from_iterable(ids), self.type, total)
            number = self.used + 1 + np.arange(len(ids))
            self.start[number], self.length[number], self.size[number] = self.fill + np.cumsum(length) - length, length, sizes[a : a + 4096]
            self._insert(keys[a : a + 4096], number.astype(np.int32))
            self.used += len(ids)
            self.fill += total

    def _insert(self, keys: np.ndarray, number: np.ndarray) -> None:
        """Put new keys into the first free places from their own on; of several at one place one stays and the others go on."""
        at = (keys & np.uint64(MEMO - 1)).astype(np.int64)
        while len(keys):
            free = np.flatnonzero(self.slot[at] == 0)
            place, first = np.unique(at[free], return_index=True)
            won = free[first]
            self.keys[place], self.slot[place] = keys[won], number[won]
            on = np.ones(len(keys), bool)
            on[won] = False
            keys, number, at = keys[on], number[on], (at[on] + 1) & (MEMO - 1)

    def _find(self, keys: np.ndarray) -> np.ndarray:
        out = np.zeros(len(keys), np.int32)
        todo = np.arange(len(keys))
        at = (keys & np.uint64(MEMO - 1)).astype(np.int64)
        while len(todo):
            slot = self.slot[at]
            hit = (self.keys[at] == keys[todo]) & (slot > 0)
            out[todo[hit]] = slot[hit]
            on = ~hit & (slot > 0)
            todo, at = todo[on], (at[on] + 1) & (MEMO - 1)
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the place of each text's first one (one more at the end). A null is an empty text."""
        raw, at = text_buffers(texts)
        n = len(at) - 1
        whole = np.ones(n, bool)
        if self.cuts and len(raw):
            space = np.flatnonzero(raw == 32)
            last = np.zeros(len(raw) + 1, bool)
            last[at] = True
            after = np.append(raw, 32)[space + 1]
            bad = ~self.bare[after] | last[space + 1]
            each = np.arange(n)
            of_space = np.repeat(each, np.diff(np.searchsorted(space, at)))
            whole[:] = False
            whole[of_space[bad]] = True
            begins = np.zeros(len(raw), bool)
            begins[space[~whole[of_space]]] = True
            begins[at[:-1][~whole & (at[1:] > at[:-1])]] = True
            starts = np.flatnonzero(begins)
            owner = np.repeat(each, np.diff(np.searchsorted(starts, at)))
            ends = np.minimum(np.append(starts[1:], len(raw)), at[owner + 1]) if len(starts) else starts
            keys = span_hashes(raw, starts, ends) if len(starts) else np.zeros(0, np.uint64)
            slots = self._find(keys)
            miss = np.flatnonzero(slots == 0)
            if len(miss):
                new, first = np.unique(keys[miss], return_index=True)
                if len(new) > MEMO * 3 // 4:  # one very long text
                    parts = [np.array(x, self.type) for x in self._whole([raw[a:b].tobytes().decode() for a, b in zip(at[:-1].tolist(), at[1:].tolist())])]
                    return np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))
                if self.used and self.used + len(new) > MEMO * 3 // 4:
                    self._clear()
                    miss = np.arange(len(keys))
                    new, first = np.unique(keys, return_index=True)
                where = miss[first]
                pieces = [raw[a:b].tobytes().decode() for a, b in zip(starts[where].tolist(), ends[where].tolist())]
                sizes = (ends[where] - starts[where]).tolist()
                self._learn(new, pieces, sizes)
                slots[miss] = self._find(keys[miss])
            length = self.length[slots].astype(np.int64)
            begin = self.start[slots]
            odd = np.flatnonzero(self.size[slots] != ends - starts)
            if len(odd):  # two pieces of one hash
                whole[owner[odd]] = True
                keep = ~whole[owner]
                owner, length, begin = owner[keep], length[keep], begin[keep]
            total = np.cumsum(length)
            ids = self.pool[np.repeat(begin - (total - length), length) + np.arange(total[-1] if len(total) else 0)]
            counts = np.bincount(owner, weights=length, minlength=n).astype(np.int64)
        else:
            ids, counts = np.zeros(0, self.type), np.zeros(n, np.int64)
        odd = np.flatnonzero(whole)
        if not len(odd):
            return ids, np.append(0, np.cumsum(counts))
        given = {k: np.array(x, self.type) for k, x in zip(odd.tolist(), self._whole([raw[at[k] : at[k + 1]].tobytes().decode() for k in odd]))}
        place = np.append(0, np.cumsum(counts))
        parts = [given[k] if whole[k] else ids[place[k] : place[k + 1]] for k in range(n)]
        return np.concatenate(parts), np.append(0, np.cumsum([len(p) for p in parts]))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker process and file; the memo outlives a task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def code_lengths(counts: np.ndarray, most: int = MOST_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code with none above ``most``, by package-merge; 0 where the count is 0."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.uint8)
    if len(used) == 1:
        out[used] = 1
    if len(used) < 2:
        return out
    if len(used) > 1 << most:
        raise ValueError(f"{len(used)} ids do not fit codes of {most} bits")
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.float64)
    now, levels = leaves, [np.ones(len(leaves), bool)]
    for _ in range(most - 1):
        packages = now[: len(now) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([leaves, packages])
        order = np.argsort(both, kind="stable")
        now = both[order]
        levels.append(order < len(leaves))
    need = 2 * len(leaves) - 2
    for leaf in reversed(levels):
        own = int(leaf[:need].sum())
        out[used[:own]] += 1
        need = 2 * (need - own)
    return out


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes counted up by length, then by id."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        longest = int(lengths.max())
        step = np.uint64(1) << (longest - lengths[order]).astype(np.uint64)
        codes[order] = (np.cumsum(step) - step) >> (longest - lengths[order]).astype(np.uint64)
    return codes


def decoding_table(lengths: np.ndarray, most: int = MOST_BITS) -> np.ndarray:
    """For every ``most`` bits ahead: the id they begin with, times 32, plus the length of its code."""
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    table = np.repeat(order.astype(np.uint32) * np.uint32(32) + lengths[order], 1 << (most - lengths[order].astype(np.int64)))
    return np.append(table, np.zeros((1 << most) - len(table), np.uint32))


def pack(ids: np.ndarray, place: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[list[bytes], list[np.ndarray]]:
    """Per document its coded bytes and the bit offset of every ``BLOCK``-th id."""
    size = lengths[ids].astype(np.int64)
    end = np.append(0, np.cumsum(size))
    total = end[place[1:]] - end[place[:-1]]
    room = (total + 7) // 8
    at = np.append(0, np.cumsum(room))
    bit = end[:-1] - np.repeat(end[place[:-1]] - at[:-1] * 8, np.diff(place))
    value = codes[ids] << (64 - (bit & 31) - size).astype(np.uint64)
    word, words = bit >> 5, int(at[-1] // 4 + 2)
    filled = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), words) + np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), words)
    data = filled.astype(np.uint64).astype(">u4").tobytes()
    payload = [data[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    return payload, [bit[a:b:BLOCK] - 8 * s for a, b, s in zip(place[:-1].tolist(), place[1:].tolist(), at[:-1].tolist())]


def unpack(payload: list[bytes], checkpoints: list[np.ndarray], counts: np.ndarray, table: np.ndarray, most: int = MOST_BITS) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all documents and where each begins: every block from its checkpoint on, all blocks in step."""
    at = np.append(0, np.cumsum([len(p) for p in payload]))
    raw = np.frombuffer(b"".join(payload) + bytes(8), np.uint8).astype(np.uint32)
    ahead = (raw[:-3] << 24) | (raw[1:-2] << 16) | (raw[2:-1] << 8) | raw[3:]
    place = np.append(0, np.cumsum(counts))
    blocks = np.array([len(c) for c in checkpoints])
    nth = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    bit = np.concatenate(checkpoints) + np.repeat(at[:-1] * 8, blocks)
    left = np.minimum(np.repeat(counts, blocks) - nth * BLOCK, BLOCK)
    into = np.repeat(place[:-1], blocks) + nth * BLOCK
    order = np.argsort(-left, kind="stable")
    bit, left, into = bit[order].astype(np.int64), left[order], into[order]
    out = np.zeros(place[-1], np.uint32)
    active = np.searchsorted(-left, -np.arange(1, BLOCK + 1), side="right")
    for k in range(int(left[0]) if len(left) else 0):
        n = active[k]
        p = bit[:n]
        entry = table[(ahead[p >> 3] >> (32 - most - (p & 7)).astype(np.uint32)) & np.uint32((1 << most) - 1)]
        out[into[:n] + k] = entry >> 5
        bit[:n] = p + (entry & 31)
    return out, place


def _encode(path: str):
    def run(batches):
        coder = encoder(path)
        end = np.array([END], coder.type).tobytes()
        for batch in batches:
            for a, b in groups_of(batch.column(1), PART):
                ids, place = coder.encode(batch.column(1)[a:b])
                raw, place = memoryview(ids.view(np.uint8)), place * coder.type.itemsize
                bytes_ = [b"".join((raw[x:y], end)) for x, y in zip(place[:-1].tolist(), place[1:].tolist())]
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.array(bytes_, pa.binary())], ["doc_id", "ids"])

    return run


def _count(kind: str):
    def run(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            _, offsets, data = batch.column(0).cast(pa.large_binary()).buffers()
            at = np.frombuffer(offsets, np.int64)[batch.column(0).offset :][: len(batch) + 1]
            ids = np.frombuffer(data, np.uint8)[at[0] : at[-1]].view(kind)
            for a in range(0, len(ids), PART):  # bincount widens what it counts to 8 bytes an id
                part = np.bincount(ids[a : a + PART])
                if len(part) > len(total):
                    part, total = total, part.astype(np.int64)
                total[: len(part)] += part
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int64)), pa.array(total[used])], ["id", "n"])

    return run


def _pack(kind: str, lengths: np.ndarray):
    def run(batches):
        codes = canonical_codes(lengths)
        for batch in batches:
            ids = [np.frombuffer(x.as_buffer(), kind) for x in batch.column(2)]
            a = 0
            while a < len(ids):
                b, n = a, 0
                while b < len(ids) and (b == a or n + len(ids[b]) <= PART):
                    n += len(ids[b])
                    b += 1
                place = np.append(0, np.cumsum([len(x) for x in ids[a:b]]))
                payload, points = pack(np.concatenate(ids[a:b]), place, codes, lengths)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[a:b], batch.column(1)[a:b], pa.array(np.diff(place), pa.int64()), pa.array(payload, pa.binary()), pa.array(points, pa.list_(pa.int64()))],
                    ["slot", "doc_id", "n_tokens", "payload", "checkpoints"],
                )
                a = b

    return run


def _number(batches):
    slot, total = None, 0
    for batch in batches:
        local = []
        for s, n in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if s != slot:
                slot, total = s, 0
            local.append(total)
            total += n
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(local, pa.int64())], [*batch.schema.names, "local"])


def _read(lengths: np.ndarray):
    def run(batches):
        table = decoding_table(lengths)
        for batch in batches:
            size = np.append(0, np.cumsum(batch.column(2).to_numpy()))
            a = 0
            while a < len(batch):
                b = max(a + 1, int(np.searchsorted(size, size[a] + PIECE, side="right")) - 1)
                part = batch.slice(a, b - a)
                counts = part.column(2).to_numpy()
                ids, place = unpack([x.as_buffer().to_pybytes() for x in part.column(3)], [np.array(x, np.int64) for x in part.column(4).to_pylist()], counts, table)
                sums = [zlib.crc32(ids[x:y].astype("<u4", copy=False)) for x, y in zip(place[:-1].tolist(), place[1:].tolist())]
                start = pa.array(part.column(5).to_numpy() + part.column(0).to_numpy())
                yield pa.RecordBatch.from_arrays([part.column(1), start, part.column(2), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])
                a = b

    return run


def slots_of(ids: DataFrame, col: str, slots: int) -> list[int]:
    """Ascending bounds that deal the ids into about ``slots`` even ranges."""
    edges = ids.select(F.percentile_approx(col, [i / slots for i in range(1, slots)], 10_000).alias("e")).first()["e"] if slots > 1 else []
    return sorted(set(edges or []))


def slot_of(col: str, bounds: list[int]):
    """Which range an id is in; null is in the first."""
    every = F.array(*[F.lit(b) for b in bounds]) if bounds else F.array().cast("array<long>")
    return F.coalesce(F.size(F.filter(every, lambda b: b <= F.col(col))), F.lit(0))


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", most: int = MOST_BITS) -> None:
    """Encode every whole text, append id 0 to each document, and write them to ``path`` in ascending order of id.

    The format is a folder of Parquet files: ``code`` holds the length of each id's canonical code;
    ``slots/slot=k`` holds the documents of the k-th range of ids, ascending, each with its coded ids
    (most significant bit first, from a whole byte on), the bit offsets of every ``BLOCK``-th id, its
    number of ids and the number of ids before it in the slot. Code lengths are optimal for the counts over
    all documents with none above ``most`` bits. The ids are written once in between, in ``path``'s own scratch folder.

    Null texts are empty: their only id is 0. Documents with a null id come first. Rows of equal id are ordered by their ids' bytes.
    """
    spark = docs.sparkSession
    kind = encoder(tokenizer).type.str
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = slots_of(docs, "doc_id", 2 * slots)
    raw = scratch_path(spark, "ids")
    docs.mapInArrow(_encode(tokenizer), "doc_id long, ids binary").write.option("compression", "snappy").parquet(raw)
    ids = spark.read.schema("doc_id long, ids binary").parquet(raw)
    counts = ids.select("ids").mapInArrow(_count(kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # at most the vocabulary
    total = np.zeros(max([r["id"] for r in counts], default=0) + 1, np.int64)
    for r in counts:
        total[r["id"]] = r["n"]
    lengths = code_lengths(total, most)
    code = [(int(i), int(n)) for i, n in enumerate(lengths) if n]
    spark.createDataFrame(code, "id int, bits int").coalesce(1).write.parquet(f"{path}/code")
    coded = ids.select(slot_of("doc_id", bounds).alias("slot"), "doc_id", "ids").mapInArrow(
        _pack(kind, lengths), "slot int, doc_id long, n_tokens long, payload binary, checkpoints array<bigint>"
    )
    ordered = coded.repartition(slots, "slot").sortWithinPartitions("slot", "doc_id", "n_tokens", "payload")
    numbered = ordered.mapInArrow(_number, "slot int, doc_id long, n_tokens long, payload binary, checkpoints array<bigint>, local long")
    numbered.write.partitionBy("slot").option("compression", "zstd").parquet(f"{path}/slots")


def read_tokens(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in a folder of :func:`write_tokens`, all ids decoded."""
    code = spark.read.schema("id int, bits int").parquet(f"{path}/code").collect()
    lengths = np.zeros(max([r["id"] for r in code], default=0) + 1, np.uint8)
    for r in code:
        lengths[r["id"]] = r["bits"]
    rows = spark.read.schema("doc_id long, n_tokens long, payload binary, checkpoints array<bigint>, local long, slot int").parquet(f"{path}/slots")
    sums = rows.groupBy("slot").agg(F.sum("n_tokens").alias("n"))  # one row per slot
    before = F.coalesce(F.sum("n").over(W.orderBy("slot").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = rows.join(F.broadcast(sums.select("slot", before.alias("before"))), "slot")
    placed = placed.select("before", "doc_id", "n_tokens", "payload", "checkpoints", "local")
    return placed.mapInArrow(_read(lengths), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write ``docs`` to a folder below the shared one and return what is read back from it. An empty table gives an empty table."""
    path = scratch_path(docs.sparkSession, f"tokens-{uuid.uuid4().hex[:8]}")
    write_tokens(docs, path, tokenizer, id_col, text_col)
    return read_tokens(docs.sparkSession, path)
