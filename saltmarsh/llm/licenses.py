"""Licence of files: sparse TF-IDF cosine to templates, then the nearest directory with a licence file."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saltmarsh.session import cut_lineage

from .hashing import groups_of, text_buffers, word_hashes

_GNU = (
    ("GPL-2.0", "GNU General Public License", "2", "June 1991"),
    ("GPL-3.0", "GNU General Public License", "3", "29 June 2007"),
    ("LGPL-2.1", "GNU Lesser General Public License", "2.1", "February 1999"),
    ("LGPL-3.0", "GNU Lesser General Public License", "3", "29 June 2007"),
    ("AGPL-3.0", "GNU Affero General Public License", "3", "19 November 2007"),
)
_CC = (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-ND", "Attribution-NoDerivatives"),
       ("BY-NC", "Attribution-NonCommercial"), ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))
_WARRANTY = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR '
    "PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
    "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: "
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. "
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution. "
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior "
    "written permission. "
)
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF '
    "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)


def _templates():
    """Notices, source headers, and the full text or the opening of licence files."""
    for name, title, version, date in _GNU:
        yield name, f"Licensed under the {title}, version {version}"
        yield name, f"This work is licensed under the {title}, version {version}"
        yield name, f"{title} Version {version}, {date} Copyright (C) Free Software Foundation, Inc."
        yield name, (
            f"This program is free software; you can redistribute it and/or modify it under the terms of the {title} as published by the Free Software Foundation; either version "
            f"{version} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
            f"the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the {title} for more details."
        )
    for short, title in _CC:
        yield f"CC-{short}-4.0", f"Licensed under CC {short} 4.0"
        yield f"CC-{short}-4.0", f"This work is licensed under the Creative Commons {title} 4.0 International License"
    yield "Apache-2.0", "Licensed under the Apache License, Version 2.0"
    yield "Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION"
    yield "Apache-2.0", (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at '
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
        '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.'
    )
    yield "BSD-2-Clause", _BSD + _BSD_END
    yield "BSD-3-Clause", _BSD + _BSD_NAMES + _BSD_END
    yield "ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
    yield "MIT", "Released under the MIT License"
    yield "MIT", "Licensed under the MIT License"
    yield "MIT", (
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software '
        "without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies "
        "or substantial portions of the Software. " + _WARRANTY
    )
    yield "MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"
    yield "MPL-2.0", "Mozilla Public License Version 2.0"
    yield "Unlicense", "This is free and unencumbered software released into the public domain"


TEMPLATES = tuple(_templates())
COSINE = 0.75
#: Two licences whose cosines differ by less are too close to call: about a third of what one word of a header weighs.
CLOSE = 0.003
#: Files that give their licence to their folder.
LICENCE_NAME = r"(?i)^(licen[cs]e|copying|unlicense)([._-].*)?$"

_LETTERS = np.arange(256, dtype=np.uint8)
_LETTERS[[b for b in range(128) if not chr(b).isalnum()]] = 32


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts and the place of each text's first word.

    A word is a run of ASCII letters, digits and characters beyond ASCII, but for the punctuation of Latin-1 and U+2000 to U+203F.
    """
    raw, at = text_buffers(texts)
    plain = _LETTERS[raw]
    for lead, spare in ((np.flatnonzero(raw[:-1] == 0xC2), 1), (np.flatnonzero((raw[:-1] == 0xE2) & (raw[1:] == 0x80)), 2)):
        for k in range(spare + 1):
            plain[lead + k] = 32
    return word_hashes(plain, at)


class Matcher:
    """Templates as sparse unit vectors over their own words; any other word weighs as the rarest of theirs."""

    def __init__(self, templates, cosine: float = COSINE, close: float = CLOSE):
        self.cosine, self.close = cosine, close
        self.names = [name for name, _ in templates]
        hashes, place = words(pa.array([text for _, text in templates], pa.string()))
        self.vocabulary = np.unique(hashes)
        self.counts = [np.unique(np.searchsorted(self.vocabulary, hashes[a:b]), return_counts=True) for a, b in zip(place[:-1], place[1:])]
        self.sizes = np.diff(place).tolist()

    def _ids(self, hashes: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, len(self.vocabulary))

    def frequencies(self, texts: pa.Array) -> np.ndarray:
        """In how many of the texts each word of the vocabulary stands; the last is the number of texts."""
        hashes, place = words(texts)
        ids, n = self._ids(hashes), len(self.vocabulary) + 1
        seen = np.unique(np.repeat(np.arange(len(texts)), np.diff(place)) * n + ids) % n
        out = np.bincount(seen, minlength=n)
        out[-1] = len(texts)
        return out

    def weigh(self, df: np.ndarray) -> Matcher:
        """Inverse document frequencies from the sums of ``frequencies``."""
        idf = 1.0 + np.log((1.0 + df[-1]) / (1.0 + df[:-1]))
        self.idf = np.append(idf, idf.max())
        self.gains = []  # what one more of a word adds to the product with the template's unit vector
        for ids, n in self.counts:
            gain = np.zeros(len(self.idf))
            gain[ids] = n * idf[ids] / np.sqrt(((n * idf[ids]) ** 2).sum()) * idf[ids]
            self.gains.append(gain)
        self.shares = np.stack([np.where(gain > 0, (gain / self.idf) ** 2, 0.0) for gain in self.gains], axis=1).astype(np.float32)
        return self

    def _cosines(self, hashes: np.ndarray, ids: np.ndarray, gain: np.ndarray, n: int) -> np.ndarray:
        """Cosines of all windows of ``n`` words (of the whole, if shorter), in time linear in the words but for a sort.

        A word that enters a window in which it stands c times adds idf^2 (2c + 1) to the squared norm.
        """
        size = len(hashes)
        n = min(n, size)
        code = np.unique(hashes, return_inverse=True)[1].astype(np.int64)
        keys = code * size + np.arange(size)
        order = np.sort(keys)
        rank = np.searchsorted(order, keys)
        here = np.arange(size)
        before = rank - np.searchsorted(order, code * size + np.maximum(here - n + 1, 0))
        after = np.searchsorted(order, code * size + np.minimum(here + n - 1, size - 1), side="right") - rank - 1
        square = self.idf[ids] ** 2
        start = (square[:n] * (2 * before[:n] + 1)).sum()
        norm = np.cumsum(np.concatenate([[start], square[n:] * (2 * before[n:] + 1) - square[: size - n] * (2 * after[: size - n] + 1)]))
        dot = np.concatenate([[0.0], np.cumsum(gain[ids])])
        return np.round((dot[n:] - dot[: size - n + 1]) / np.sqrt(norm), 9)

    def best(self, texts: pa.Array) -> list[tuple]:
        """Per text (licence, cosine, contested): all windows as long as a template are held to it.

        No window's cosine is above the norm of the template's words that the text has at all; this leaves few texts for
        each template. The norm of a window is at least that of its words taken as distinct. Windows that pass by this
        bound, from running sums, get their cosine.
        """
        hashes, place = words(texts)
        ids, length = self._ids(hashes), np.diff(place)
        text_of = np.repeat(np.arange(len(texts)), length)
        seen = np.zeros((len(texts), len(self.vocabulary) + 1), np.float32)
        seen[text_of, ids] = 1.0
        can = seen @ self.shares >= self.cosine**2 - 1e-4
        found: dict[int, list] = {}
        for j in np.flatnonzero(can.any(axis=0)).tolist():
            name, n, gain = self.names[j], self.sizes[j], self.gains[j]
            keep, members = can[text_of, j], np.flatnonzero(can[:, j])
            some, own = hashes[keep], ids[keep]
            starts = np.concatenate([[0], np.cumsum(length[members])])
            here = np.arange(len(own))
            first, end = np.repeat(starts[:-1], length[members]), np.repeat(starts[1:], length[members])
            square = np.concatenate([[0.0], np.cumsum(self.idf[own] ** 2)])
            dot = np.concatenate([[0.0], np.cumsum(gain[own])])
            stop = np.minimum(here + n, end)
            near = dot[stop] - dot[:-1] >= (self.cosine - 1e-6) * np.sqrt(square[stop] - square[:-1])
            hit = np.flatnonzero(near & ((here + n <= end) | (here == first)))
            which = np.searchsorted(starts, hit, side="right") - 1
            for t in np.unique(which).tolist():
                at = hit[which == t]
                a, b = int(at[0]), int(stop[at[-1]])
                cosines = self._cosines(some[a:b], own[a:b], gain, n)
                good = np.flatnonzero(cosines >= self.cosine)
                if len(good):
                    found.setdefault(int(members[t]), []).append((name, a - int(starts[t]) + good, min(n, b - a), cosines[good]))
        out = [(None, None, False)] * len(texts)
        for t, matches in found.items():
            top, name, a, n = max((float(c.max()), name, int(at[c.argmax()]), n) for name, at, n, c in matches)
            rival = max((float(c[(at < a + n) & (at + m > a)].max(initial=0.0)) for other, at, m, c in matches if other != name), default=0.0)
            contested = rival > 0.0 and top - rival < self.close
            out[t] = (None, None, True) if contested else (name, top, False)
        return out


def _frequencies(matcher: Matcher):
    def run(batches):
        total = np.zeros(len(matcher.vocabulary) + 1, np.int64)
        for batch in batches:
            texts = batch.column(0)
            for a, b in groups_of(texts):
                total += matcher.frequencies(texts.slice(a, b - a))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(total, pa.int64())], ["word", "n"])

    return run


def _match(matcher: Matcher):
    def run(batches):
        for batch in batches:
            texts, best = batch.column(2), []
            for a, b in groups_of(texts):
                best += matcher.best(texts.slice(a, b - a))
            own, cosine, contested = zip(*best) if best else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(own, pa.string()), pa.array(cosine, pa.float64()), pa.array(contested, pa.bool_())],
                ["id", "path", "own", "cosine", "contested"],
            )

    return run


def scan_licenses(
    files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text", templates=TEMPLATES, cosine: float = COSINE,
    close: float = CLOSE, licence_name: str = LICENCE_NAME,
) -> DataFrame:
    """(id, path, own, cosine, contested, license, inherited_from) per file.

    Every window of a file that has as many words as a template is held to it (a shorter file as a whole). ``own`` is the
    licence of the greatest cosine of TF-IDF vectors, if that is ``cosine`` or more; of equal cosines the last name. A
    window of another licence that overlaps it and whose cosine is less than ``close`` below makes the file contested: it then has no
    licence of its own. Document frequencies are counted over all files. A file without a licence takes that of the nearest
    directory on its path, its own included, that has a file whose name matches ``licence_name`` and has one.
    Directories are resolved once each and joined to the files.

    Null or empty text: no template. Null path: nothing is inherited. Two licence files in one folder: the larger cosine,
    then the last name. Repeated rows are scanned each for itself. Other columns are not read. An empty table gives an empty table.
    """
    rows = files.select(F.col(id_col).cast("long").alias("id"), F.col(path_col).alias("path"), F.col(text_col).alias("text"))
    matcher = Matcher(templates, cosine, close)
    sums = rows.select("text").mapInArrow(_frequencies(matcher), "word int, n long").groupBy("word").agg(F.sum("n").alias("n"))
    df = np.zeros(len(matcher.vocabulary) + 1)
    for r in sums.collect():  # one row per word of the templates
        df[r["word"]] = r["n"]
    own = cut_lineage(rows.mapInArrow(_match(matcher.weigh(df)), "id long, path string, own string, cosine double, contested boolean"))

    folder = F.regexp_replace("path", "/?[^/]*$", "")
    name = F.regexp_extract("path", "([^/]*)$", 1)
    licensed = own.where(name.rlike(licence_name) & F.col("own").isNotNull()).groupBy(folder.alias("at"))
    licensed = licensed.agg(F.max_by("own", F.struct("cosine", F.col("own"))).alias("given"))
    folders = own.where("path IS NOT NULL").select(folder.alias("folder")).distinct()
    parts = F.split("folder", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("at")))
    nearest = folders.select("folder", F.explode(up).alias("u")).select("folder", "u.depth", "u.at").join(licensed, "at")
    nearest = nearest.groupBy("folder").agg(F.max(F.struct("depth", "at", "given")).alias("n"))
    out = own.withColumn("folder", folder).join(nearest, "folder", "left")
    return out.select(
        F.col("id").alias(id_col), F.col("path").alias(path_col), "own", "cosine", "contested",
        F.coalesce("own", "n.given").alias("license"), F.when(F.col("own").isNull(), F.col("n.at")).alias("inherited_from"),
    )
