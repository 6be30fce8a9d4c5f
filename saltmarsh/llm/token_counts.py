"""Token counts that follow edits: a segment tree of pre-token runs per document."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saltmarsh.llm.tokens import encoder

LEAF = 192  # code points of a leaf, about
#: A token never spans the place before such a space.
_CUT = re.compile(r" (?=[^\s\x00-\x20])")


class CountTree:
    """A text as leaves that are cut where no token spans, with sums of code points and tokens over them."""

    def __init__(self, leaves: list[str], counts: list[int], count):
        self.count = count  # token count of a string
        self.width = 1 << max(0, (len(leaves) - 1).bit_length())
        self.text = leaves + [""] * (self.width - len(leaves))
        self.chars = [0] * self.width + [len(t) for t in self.text]
        self.tokens = [0] * self.width + counts + [0] * (self.width - len(counts))
        for k in range(self.width - 1, 0, -1):
            self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
            self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]
        self.recoded = 0

    def total(self) -> int:
        return self.tokens[1]

    def _leaf(self, at: int) -> tuple[int, int]:
        """Leaf that holds code point ``at`` (the last one with text for the end) and its place within."""
        k = 1
        at = min(at, self.chars[1])
        while k < self.width:
            k *= 2
            if at >= self.chars[k] and self.chars[k + 1]:
                at -= self.chars[k]
                k += 1
        return k - self.width, at

    def _put(self, leaf: int, text: str, tokens: int) -> None:
        self.text[leaf] = text
        k = leaf + self.width
        chars, tokens = len(text) - self.chars[k], tokens - self.tokens[k]
        while k:
            self.chars[k] += chars
            self.tokens[k] += tokens
            k //= 2

    def edit(self, at: int, delete: int, insert: str) -> None:
        """Replace ``delete`` code points from ``at`` on by ``insert``; places beyond the end are the end.

        Only the leaves that are touched and one leaf with text on either side are encoded anew: the
        cuts outside of those, and the two characters that make them cuts, are as before.
        """
        at = max(0, min(at, self.chars[1]))
        delete = max(0, min(delete, self.chars[1] - at))
        first, inside = self._leaf(at)
        last, _ = self._leaf(at + delete)
        start = at - inside
        if start > 0:
            first, back = self._leaf(start - 1)
            inside += back + 1
        end = sum(self.chars[self.width + first : self.width + last + 1]) + at - inside
        if end < self.chars[1]:
            last, _ = self._leaf(end)
        before = "".join(self.text[first : last + 1])
        after = before[:inside] + insert + before[inside + delete :]
        pieces = leaves(after)
        room = last - first + 1
        pieces = pieces[: room - 1] + ["".join(pieces[room - 1 :])]
        pieces += [""] * (room - len(pieces))
        for k, piece in enumerate(pieces):
            self._put(first + k, piece, self.count(piece) if piece else 0)
        self.recoded += len(after)


def leaves(text: str, size: int = LEAF) -> list[str]:
    """The text cut into leaves of about ``size`` code points."""
    out, a = [], 0
    while a < len(text):
        m = _CUT.search(text, a + size)
        b = m.start() if m else len(text)
        out.append(text[a:b])
        a = b
    return out


def _counts(path: str):
    def run(batches):
        coder = encoder(path)

        def count(text: str) -> int:
            return len(coder.tokenizer.encode(text, add_special_tokens=False).ids)

        for batch in batches:
            rows = []
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                cut = [leaves(t or "") if coder.cuts else [t or ""] for t in part.column(1).to_pylist()]
                _, place = coder.encode(pa.array([x for c in cut for x in c], pa.large_string()))
                sizes = (place[1:] - place[:-1]).tolist()
                done = 0
                for own, edits in zip(cut, part.column(2).to_pylist()):
                    tree = CountTree(own, sizes[done : done + len(own)], count)
                    done += len(own)
                    before = tree.total()
                    for e in sorted((x for x in edits or [] if x), key=lambda x: x["seq"]):
                        tree.edit(e["at"] or 0, e["delete"] or 0, e["insert"] or "")
                    rows.append((before, tree.total(), tree.chars[1], tree.recoded))
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["id", "n_tokens", "edited_tokens", "edited_chars", "recoded_chars"])

    return run


def edited_counts(df: DataFrame, edits: Column, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, edited_tokens, edited_chars, recoded_chars) per row: token counts before and after its edits.

    ``edits`` is an array of (seq long, at long, delete long, insert string), made in order of ``seq``, places in code points.
    A document's tree stays in memory while its edits are made; only touched regions are encoded
    again. Tokenizers without cuts have one leaf per document, so that an edit encodes the whole text.

    Null text: empty. Null edits or a null edit: none; null fields: 0 or empty. Repeated rows are counted each for itself.
    Other columns are not read. An empty table gives an empty table.
    """
    kind = "array<struct<seq:bigint,at:bigint,delete:bigint,insert:string>>"
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), edits.cast(kind).alias("edits"))
    out = rows.mapInArrow(_counts(tokenizer), "id long, n_tokens long, edited_tokens long, edited_chars long, recoded_chars long")
    return out.withColumnRenamed("id", id_col)


def with_edits(df: DataFrame, log: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``df`` with the edits of a log (id, seq, at, delete, insert) as the array column ``edits``."""
    gathered = log.groupBy(id_col).agg(F.collect_list(F.struct("seq", "at", "delete", "insert")).alias("edits"))
    return df.join(gathered, id_col, "left")
