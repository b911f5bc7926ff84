"""License scan by diagonal voting.

Every rolling word pair of every text is joined with the places it has in the
templates (a broadcast table, bounded by ``MAX_PAIRS``). A match votes for the
diagonal ``text position - template position``. Templates of which a text doesn't have enough different
pairs, wherever they stand, can't be found in it; their votes go no further. The others are gathered as bit masks
of template positions, ``BITS`` of them to a mask. A diagonal with all votes is an exact
occurrence, whatever lies beside it. Of the others a diagonal counts if none within ``SLACK`` words
has more votes (ties: the first); the diagonals within ``SLACK`` of it are merged into it, as words put in
or left out move the diagonal, and the merged span is verified: it must cover
``COVER`` of the template's pairs. Templates of fewer than ``SHORT`` pairs must be
covered whole: one word makes another license of them.

Rows: a null text is empty; texts without two words have no pairs and no labels.
Rows are known by a hash of id and text, so repeated rows get equal results, and
rows of one id with different texts (or null ids) their own. Input columns other
than id and text aren't read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import arrow_map, shared_table
from .text import ALNUM, LOWER, chunks, hash_word_list, roll, span_hash, words

K = 2
SLACK = 3
COVER = 0.7
SHORT = 8
BITS = 62

#: Phrases whose words must stand consecutively, and their labels.
BASE_PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}

#: License notices that the voting looks for, exactly or with small changes.
NOTICES = {
    "released under the MIT License": "mit",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files": "mit",
    "licensed under the Apache License, Version 2.0": "apache-2.0",
    "you may not use this file except in compliance with the License. You may obtain a copy of the License at":
        "apache-2.0",
    "licensed under the GNU General Public License, version 3": "gpl-3.0",
    "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the "
    "Free Software Foundation": "gpl",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
    "the following conditions are met": "bsd",
    "licensed under CC BY-NC 4.0": "cc-by-nc-4.0",
    "licensed under CC BY 4.0": "cc-by-4.0",
    "licensed under a Creative Commons Attribution 4.0 International License": "cc-by-4.0",
}

_WARRANTY = (
    "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR "
    "CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF "
    "CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.")
_BSD_CONDITIONS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution.")
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, "
    "BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
    "EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR "
    "CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR "
    "PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR "
    "TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE.")

#: Whole license texts and the notices that long licenses ask to be put into files.
WHOLE_TEXTS = {
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
    "files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, "
    "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
    "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
    "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, "
    "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
    "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
    "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
    "OTHER DEALINGS IN THE SOFTWARE.": "mit",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies. " + _WARRANTY: "isc",
    _BSD_CONDITIONS + " " + _BSD_DISCLAIMER: "bsd-2-clause",
    _BSD_CONDITIONS + " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission. " + _BSD_DISCLAIMER: "bsd-3-clause",
    "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the "
    "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
    "or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
    "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
    "limitations under the License.": "apache-2.0",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
    "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This "
    "program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
    "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have "
    "received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>.":
        "gpl-3.0-or-later",
}
TEMPLATES = {**NOTICES, **WHOLE_TEXTS}

MAX_PAIRS = 1 << 20     # word pairs of all templates: bounds the table that is broadcast


def _templates(spark, phrases: dict[str, str], notices: dict[str, str]) -> DataFrame:
    """(h, tid, at, grams, base, label): the word pairs of all templates."""
    rows = []
    every = [(t, label, True) for t, label in phrases.items()] + [(t, label, False) for t, label in notices.items()]
    hashes = hash_word_list([t.encode() for t, _, _ in every], ALNUM)
    for tid, ((_, label, base), h) in enumerate(zip(every, hashes)):
        grams = roll(h, K).view(np.int64).tolist()
        if not grams:
            raise ValueError("a template needs at least two words")
        rows += [(g, tid, at, len(grams), base, label) for at, g in enumerate(grams)]
    if len(rows) > MAX_PAIRS:
        raise ValueError("more word pairs in the templates than may be broadcast")
    return spark.createDataFrame(rows, "h long, tid int, at int, grams int, base boolean, label string")


def _grams(batches):
    for batch in batches:
        keys = np.asarray(batch.column("key"))
        for lo, hi, data, offs in chunks(batch, "text"):
            data = LOWER[data]
            s, e, first = words(data, offs, ALNUM)
            h = roll(span_hash(data, s, e), K)
            doc = np.repeat(np.arange(hi - lo), np.diff(first))
            keep = doc[:len(h)] == doc[K - 1:] if len(h) else np.zeros(0, bool)
            doc = doc[:len(h)][keep]
            pos = (np.arange(len(h))[keep] - first[doc]).astype(np.int32)
            grams = h[keep].view(np.int64)
            for a in range(0, len(doc), 1 << 16):
                b = a + (1 << 16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[lo:hi][doc[a:b]]), pa.array(pos[a:b]), pa.array(grams[a:b])], ["key", "pos", "h"])


_VOTE = "key long, pos int, tid int, at int, grams int, base boolean, label string"


def _possible(batches):
    """The votes of templates of which a text has enough different pairs to be found at all.

    The join keeps the order of ``_grams``, so the votes of a text come together; a text's
    votes are held until the next text begins.
    """
    held: list[pa.Table] = []

    def kept(table: pa.Table):
        key, tid, at, grams = (table[c].to_numpy() for c in ("key", "tid", "at", "grams"))
        run = np.cumsum(np.append(True, key[1:] != key[:-1]))
        order = np.lexsort((at, tid, run))
        run, tid, at, grams = run[order], tid[order], at[order], grams[order]
        new = np.append(True, (run[1:] != run[:-1]) | (tid[1:] != tid[:-1]))
        other = new | np.append(True, at[1:] != at[:-1])
        group = np.cumsum(new) - 1
        need = np.where(grams < SHORT, grams, np.ceil(COVER * grams - 1e-9))
        good = np.bincount(group, other)[group] >= need
        yield from table.take(pa.array(np.sort(order[good]))).to_batches()

    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(pa.Table.from_batches([batch]))
        table = pa.concat_tables(held).combine_chunks()
        key = table["key"].to_numpy()
        change = np.flatnonzero(key[1:] != key[:-1])
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut:
            yield from kept(table.slice(0, cut).combine_chunks())
        held = [table.slice(cut)]
    if held:
        yield from kept(held[0].combine_chunks())


def _word_counts(batches):
    for batch in batches:
        counts = [np.diff(words(LOWER[data], offs, ALNUM)[2]) for _, _, data, offs in chunks(batch, "text")]
        n = pa.array(np.concatenate(counts) if counts else [], pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), n], ["doc_id", "key", "n_words"])


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  phrases: dict[str, str] = BASE_PHRASES, notices: dict[str, str] = TEMPLATES) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of every row.

    ``spans``: (label, first, end, cover) of each verified notice, words from 0, ends exclusive.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    docs = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    grams = arrow_map(docs.select("key", "text"), _grams, "key long, pos int, h long")
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = arrow_map(docs, _word_counts, f"doc_id {kind}, key long, n_words long")

    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at") % BITS)
    template = ["key", "tid", "base", "label", "grams"]
    joined = grams.join(F.broadcast(_templates(docs.sparkSession, phrases, notices)), "h")
    votes = arrow_map(joined.select(*(c.split()[0] for c in _VOTE.split(", "))), _possible, _VOTE)
    votes = (votes.groupBy(*template, (F.col("pos") - F.col("at")).alias("diagonal"), F.floor(F.col("at") / BITS).alias("mask_no"))
             .agg(F.bit_or(bit).alias("mask"), F.min("pos").alias("first"), (F.max("pos") + K).alias("end")))
    votes = shared_table(votes, "license-votes")
    lines = votes.groupBy(*template, "diagonal").agg(F.sum(F.bit_count("mask")).alias("hits"))
    exact = lines.filter(F.col("hits") == F.col("grams")).select(
        *template, F.col("diagonal").alias("first"), (F.col("diagonal") + F.col("grams") + K - 1).alias("end"), F.lit(1.0).alias("cover"))
    near = W.partitionBy("key", "tid").orderBy("diagonal").rangeBetween(-SLACK, SLACK)
    rank = F.struct("hits", -F.col("diagonal"))
    peaks = (lines.filter(~F.col("base") & (F.col("grams") >= SHORT)).withColumn("best", F.max(rank).over(near))
             .filter((F.col("best") == rank) & (F.col("hits") < F.col("grams")))
             .select("key", "tid", F.col("diagonal").alias("peak"),
                     F.explode(F.sequence(F.col("diagonal") - SLACK, F.col("diagonal") + SLACK)).alias("diagonal")))
    merged = (votes.join(peaks, ["key", "tid", "diagonal"]).groupBy(*template, "peak", "mask_no")
              .agg(F.bit_or("mask").alias("mask"), F.min("first").alias("first"), F.max("end").alias("end"))
              .groupBy(*template, "peak").agg((F.sum(F.bit_count("mask")) / F.first("grams")).alias("cover"),
                                              F.min("first").alias("first"), F.max("end").alias("end")))
    found = exact.unionByName(merged.filter(F.col("cover") >= COVER).drop("peak"))
    base = F.col("base")
    per_text = found.groupBy("key").agg(
        F.count_if(base).alias("n_base"),
        F.min(F.when(base, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("long").alias("last_word"),
        F.collect_set(F.when(base, F.col("label"))).alias("base_set"), F.collect_set("label").alias("set"),
        F.max("cover").alias("score"),
        F.sort_array(F.collect_list(F.when(~base, F.struct("first", "end", "label", "cover")))).alias("spans"))
    text = lambda c: F.array_join(F.array_sort(F.coalesce(c, F.array().cast("array<string>"))), ",")
    return rows.join(per_text, "key", "left").select(
        "doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        text(F.col("base_set")).alias("base_labels"), text(F.col("set")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), "spans")
