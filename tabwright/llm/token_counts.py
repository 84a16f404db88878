"""Edit-aware token counts: a tree of pre-token sums per document, renewed only where edits touch it.

A document's pre-tokens lie in chunks; over the chunks stands a segment tree of characters and tokens. An edit descends to
the chunk it begins in, goes back to a pre-token before any that can have seen the edit, splits and encodes anew from there,
and stops at the first pre-token boundary behind the edit that the old text had too: from such a boundary on, the same
text splits the same way. Only then are the sums above the touched chunks renewed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.bpe import Codec
from tabwright.llm.shipping import ship

CHUNK = 64
ROWS_AT_ONCE = 500


class CountTree:
    """A text's pre-tokens in chunks, and the sums of their characters and tokens up to the root."""

    def __init__(self, codec: Codec, text: str, lengths: np.ndarray, tokens: np.ndarray):
        self.codec, self.text = codec, text
        self.renewed = 0
        cuts = range(0, max(1, len(lengths)), CHUNK)
        self.chunks = [(lengths[c : c + CHUNK].tolist(), tokens[c : c + CHUNK].tolist()) for c in cuts]
        size = 1 << (len(self.chunks) - 1).bit_length()
        self.size = size
        self.sums = [(0, 0)] * (2 * size)
        for k, chunk in enumerate(self.chunks):
            self.sums[size + k] = (sum(chunk[0]), sum(chunk[1]))
        for k in range(size - 1, 0, -1):
            self._add(k)

    def _add(self, node: int) -> None:
        a, b = self.sums[2 * node], self.sums[2 * node + 1]
        self.sums[node] = (a[0] + b[0], a[1] + b[1])

    def _renew(self, chunk: int) -> None:
        node = self.size + chunk
        self.sums[node] = tuple(map(sum, self.chunks[chunk]))
        while node > 1:
            node >>= 1
            self._add(node)

    @property
    def tokens(self) -> int:
        return self.sums[1][1]

    def _find(self, at: int) -> tuple[int, int]:
        """The chunk that holds character ``at``, or the last one, and where that chunk begins."""
        node, start = 1, 0
        while node < self.size:
            node *= 2
            if at >= start + self.sums[node][0] and node + 1 < 2 * self.size and self.sums[node + 1][0]:
                start += self.sums[node][0]
                node += 1
        return node - self.size, start

    def _before(self, at: int) -> tuple[int, int, int]:
        """Where to begin again for an edit at ``at``: chunk, place in it, and the place's character.

        That is one before the first pre-token that ends at ``at`` or later. A run of blanks looks ahead to its end, and
        may be two pre-tokens; any other looks one character ahead.
        """
        chunk, start = self._find(max(0, at - 1))
        lengths = self.chunks[chunk][0]
        place = 0
        while place < len(lengths) and start + lengths[place] < at:
            start += lengths[place]
            place += 1
        while place == 0 and chunk > 0:
            chunk -= 1
            lengths = self.chunks[chunk][0]
            place = len(lengths)
        if place:
            place -= 1
            start -= lengths[place]
        return chunk, place, start

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in the place of the characters from ``start`` to ``end``."""
        if start == end and not new:
            return
        chunk, place, begin = self._before(start)
        self.text = text = self.text[:start] + new + self.text[end:]
        shift = len(new) - (end - start)
        # Walk the new pre-tokens and the old boundaries side by side until they agree behind the edit.
        words: list[str] = []
        at, last, skip, old = begin, chunk, place, begin
        for found in self.codec.split_from(text, begin):
            words.append(found)
            at += len(found)
            while old + shift < at or old < end:
                if skip >= len(self.chunks[last][0]):
                    if last + 1 >= len(self.chunks):
                        break
                    last, skip = last + 1, 0
                    continue
                old += self.chunks[last][0][skip]
                skip += 1
            if old >= end and old + shift == at and at >= start + len(new):
                break
        else:
            last, skip = len(self.chunks) - 1, len(self.chunks[-1][0])
        self.renewed += len(words)
        counts = self.codec.count_words(words)
        tail = [x[skip:] for x in self.chunks[last]]
        fresh = ([len(w) for w in words], counts)
        self.chunks[chunk] = tuple(a[:place] + b + c for a, b, c in zip(self.chunks[chunk], fresh, tail, strict=True))
        for k in range(chunk + 1, last + 1):
            self.chunks[k] = ([], [])
        for k in range(chunk, last + 1):
            self._renew(k)


def edits_of(text: Column, pattern: str, replacement: str) -> Column:
    """Edits that put ``replacement`` in the place of every match of ``pattern``; none for a null text."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    runs = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.length)
    kind = "array<struct<start:bigint,end:bigint,replacement:string>>"
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(kind).alias("edits"))

    def add(state: Column, m: Column) -> Column:
        start = state["at"] + m["gap"]
        end = start + F.coalesce(m["run"], F.lit(0))
        edit = F.struct(start.alias("start"), end.alias("end"), F.lit(replacement).alias("replacement"))
        return F.struct(end.alias("at"), F.when(m["run"].isNotNull(), F.array_append(state["edits"], edit)).otherwise(state["edits"]).alias("edits"))

    found = F.aggregate(F.arrays_zip(gaps.alias("gap"), runs.alias("run")), zero, add, lambda s: s["edits"])
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(kind))


def recount(docs: DataFrame, edits: Column, codec: Codec, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_before, n_edits, n_after, n_renewed, text)`` for every row.

    ``edits`` is an array of ``(start, end, replacement)`` per row, in code points of the text, end exclusive, in any order
    and without overlap. ``n_renewed`` counts the pre-tokens encoded again, out of those of the whole text. A null text is
    empty; null edits, or none, leave the count; a null replacement deletes; an edit beyond the text's end, or one that
    overlaps an earlier one, fails. A text that holds an added token before or after an edit is counted anew, since such
    tokens cut the text first. Null ids pass through; repeated rows come out repeated; other columns are not read; an
    empty table gives no rows.
    """
    ship(docs.sparkSession)
    kind = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("replacement", T.StringType())]))
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), edits.cast(kind).alias("edits"))
    sent = docs.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec_ = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                texts = [t or "" for t in part.column("text").to_pylist()]
                states = codec_.pre_tokens(texts)
                rows = [_recounted(codec_, t, lengths, tokens, e or []) for t, (lengths, tokens), e in zip(texts, states, part.column("edits").to_pylist(), strict=True)]
                columns = [pa.array(c, pa.int64()) for c in list(zip(*(r[:4] for r in rows), strict=True))] if rows else [pa.array([], pa.int64())] * 4
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *columns, pa.array([r[4] for r in rows], pa.string())], ["doc_id", "n_before", "n_edits", "n_after", "n_renewed", "text"])

    counts = [T.StructField(c, T.LongType()) for c in ("n_before", "n_edits", "n_after", "n_renewed")]
    return plain.mapInArrow(run, T.StructType([plain.schema["doc_id"], *counts, T.StructField("text", T.StringType())]))


def _recounted(codec: Codec, text: str, lengths: np.ndarray, tokens: np.ndarray, edits: list[dict]) -> tuple[int, int, int, int, str]:
    before = int(tokens.sum())
    if not edits:
        return before, 0, before, 0, text
    ordered = sorted(((e["start"], e["end"], e["replacement"] or "") for e in edits), reverse=True)
    right = len(text)
    for start, end, _ in ordered:
        if not 0 <= start <= end <= right:
            raise ValueError(f"edit {start}:{end} overlaps another or leaves the text")
        right = start
    if codec.holds_added(text):
        return _whole(codec, text, before, ordered)
    tree = CountTree(codec, text, lengths, tokens)
    for start, end, new in ordered:  # from the back, so that places before stay as they are
        tree.replace(start, end, new)
    if codec.holds_added(tree.text):
        return _whole(codec, text, before, ordered)
    return before, len(edits), tree.tokens, tree.renewed, tree.text


def _whole(codec: Codec, text: str, before: int, ordered: list[tuple[int, int, str]]) -> tuple[int, int, int, int, str]:
    for start, end, new in ordered:
        text = text[:start] + new + text[end:]
    ((lengths, tokens),) = codec.pre_tokens([text])
    return before, len(ordered), int(tokens.sum()), len(lengths), text
