"""Byte-level BPE encoding and decoding, the merges found through a segment tree over adjacent pair ranks.

The tree's leaves are the merge ranks of neighbouring symbols, and a node holds the smaller child, the left one on ties:
the root is the leftmost merge of lowest rank. A merge changes three leaves, each renewed along its path to the root,
until the root shows that no pair merges. The distinct pre-tokens of many texts go together: short ones as rows of one
array of trees, each step merging once in every row; long ones, which may be whole texts, in a tree of their own.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.shipping import ship

ROWS_AT_ONCE = 1_000
REMEMBERED = 400_000
LARGEST_ROW = 32  # leaves of a tree that is a row
# Fixed value: the pattern of the byte-level pre-tokenizer. White space is Unicode's own, which leaves out U+001C to
# U+001F; those count as marks.
_S = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PATTERN = rf"'(?:[stmd]|re|ve|ll)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_S}\p{{L}}\p{{N}}]+|[{_S}]+(?![^{_S}])|[{_S}]+"
_NONE = 1 << 40


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else the next free code point from 256."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of every run, one run after the other."""
    ends = np.cumsum(counts)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - ends + counts, counts)


class _Memory(dict):
    """Numbers pre-tokens as they turn up, and keeps the ids of those that are settled."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []
        self.starts = self.counts = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.int32)

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number

    def settle(self, codec: Codec) -> None:
        if self.new:
            bounds, ids = codec.merged_all(self.new)
            self.starts = np.concatenate([self.starts, bounds[:-1] + len(self.ids)])
            self.counts = np.concatenate([self.counts, np.diff(bounds)])
            self.ids = np.concatenate([self.ids, ids])
            self.new = []


class Codec:
    """Encoder and decoder of a ``tokenizer.json`` of the byte-level BPE kind."""

    def __init__(self, specification: str):
        self.specification = specification

    def __reduce__(self):
        return Codec, (self.specification,)

    @cached_property
    def _parts(self) -> tuple:
        spec = json.loads(self.specification)
        model, letters = spec["model"], byte_letters()
        vocabulary = model["vocab"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        merges = {(vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(pairs)}
        back = {c: b for b, c in enumerate(letters)}
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pieces = {i: bytes(back[c] for c in t) if all(c in back for c in t) else t.encode() for t, i in vocabulary.items()}
        pieces |= {i: t.encode() for t, i in added.items()}
        split = regex.compile("|".join(map(regex.escape, sorted(added, key=len, reverse=True)))) if added else None
        return [vocabulary[c] for c in letters], merges, added, split, pieces

    @cached_property
    def _words(self):
        return regex.compile(PATTERN)

    @cached_property
    def _arrays(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The byte symbols, the pairs that merge in order with their ranks, and each rank's merged symbol."""
        first, merges = self._parts[:2]
        keys = np.array([a << 32 | b for a, b in merges], np.int64)
        ranks, new = (np.array([m[k] for m in merges.values()], np.int64) for k in (0, 1))
        order = np.argsort(keys)
        made = np.zeros(len(new), np.int64)
        made[ranks] = new
        return np.array(first, np.int64), keys[order], ranks[order], made

    def merged(self, word: bytes) -> list[int]:
        """Ids of one pre-token, by a tree of its own."""
        first, merges = self._parts[:2]
        ids = [first[b] for b in word]
        n = len(ids)
        if n < 2:
            return ids
        size = 1 << (n - 2).bit_length()
        # tree[size + i]: rank and place of the pair that begins at symbol i, as one number.
        tree = [_NONE] * (2 * size)
        get, shift = merges.get, n.bit_length()
        for i in range(n - 1):
            found = get((ids[i], ids[i + 1]))
            if found:
                tree[size + i] = found[0] << shift | i
        for k in range(size - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        mask = (1 << shift) - 1
        while tree[1] != _NONE:
            i = tree[1] & mask
            j = after[i]
            ids[i] = get((ids[i], ids[j]))[1]
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
            h = before[i]
            for at, left, right in ((i, i, k), (j, j, n), (h, h, i)):
                node = size + at
                if at < 0 or node >= 2 * size:  # no symbol before, or the last symbol, which begins no pair
                    continue
                found = get((ids[left], ids[right])) if right < n else None
                tree[node] = found[0] << shift | at if found else _NONE
                while node > 1:
                    node >>= 1
                    low = min(tree[2 * node], tree[2 * node + 1])
                    if tree[node] == low:
                        break
                    tree[node] = low
        return [x for x in ids if x >= 0]

    def _leaf(self, left: np.ndarray, right: np.ndarray, place: np.ndarray | int) -> np.ndarray:
        """Rank and place of pairs as one number, the lower first; a place has 6 bits."""
        _, keys, ranks, _ = self._arrays
        if not len(keys):
            return np.full(left.shape, _NONE)
        wanted = left << 32 | right
        at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        return np.where((left >= 0) & (right >= 0) & (keys[at] == wanted), ranks[at] << 6 | place, _NONE)

    def _merge_rows(self, ids: np.ndarray, size: int) -> np.ndarray:
        """Merge every row of symbols (-1 where there are none) to its end; symbols that went into others become -1."""
        made, n = self._arrays[3], (ids >= 0).sum(axis=1)
        tree = np.full((len(ids), 2 * size + 1), _NONE)  # the last column takes what belongs to no leaf
        tree[:, size : 2 * size] = self._leaf(ids[:, :-1], ids[:, 1:], np.arange(size))
        for k in range(size - 1, 0, -1):
            tree[:, k] = np.minimum(tree[:, 2 * k], tree[:, 2 * k + 1])
        places = np.arange(size + 2, dtype=np.int16)
        after, before = np.tile(places + 1, (len(ids), 1)), np.tile(places - 1, (len(ids), 1))
        ids = np.concatenate([ids, np.full((len(ids), 2), -1)], axis=1)
        row = np.flatnonzero(tree[:, 1] < _NONE)
        while len(row):
            root = tree[row, 1]
            i = root & 63
            j = after[row, i].astype(np.int64)
            k = after[row, j].astype(np.int64)
            h = before[row, i].astype(np.int64)
            now = made[root >> 6]
            ids[row, i], ids[row, j], after[row, i], before[row, k] = now, -1, k, i
            tree[row, size + j] = _NONE
            tree[row, size + i] = np.where(k < n[row], self._leaf(now, ids[row, k], i), _NONE)
            led = h >= 0
            tree[row[led], size + h[led]] = self._leaf(ids[row[led], h[led]], now[led], h[led])
            for at in (i, np.where(j < size, j, i), np.where(led, h, i)):
                node = (size + at) >> 1
                for _ in range(size.bit_length() - 1):
                    tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
                    node >>= 1
            row = row[tree[row, 1] < _NONE]
        return ids

    def merged_all(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bounds and ids of many pre-tokens."""
        raw = [w.encode() for w in words]
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        symbols = self._arrays[0][np.frombuffer(b"".join(raw), np.uint8)]
        starts = np.concatenate([[0], np.cumsum(sizes)])
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 1
        while size <= LARGEST_ROW:
            which = np.flatnonzero((sizes <= size + 1) & (sizes > (size // 2 + 1 if size > 1 else 0)))
            if len(which):
                places = np.arange(size + 1)
                inside = places < sizes[which, None]
                at = np.minimum(starts[which, None] + places, len(symbols) - 1)
                ids = self._merge_rows(np.where(inside, symbols[at], -1), size)
                left = ids >= 0
                found.append((which, left.sum(axis=1), ids[left]))
            size *= 2
        for w in np.flatnonzero(sizes > LARGEST_ROW + 1).tolist():
            ids = np.array(self.merged(raw[w]), np.int64)
            found.append((np.array([w]), np.array([len(ids)]), ids))
        counts = np.zeros(len(raw), np.int64)
        for which, n, _ in found:
            counts[which] = n
        bounds = np.concatenate([[0], np.cumsum(counts)])
        out = np.empty(int(bounds[-1]), np.int32)
        for which, n, ids in found:
            out[spread(bounds[which], n)] = ids
        return bounds, out

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bounds and ids of many texts."""
        added, split = self._parts[2:4]
        memory, ends = self._memory, []
        stream: list[int] = []  # a pre-token's number; or, below zero, an added token
        for text in texts:
            at = 0
            for m in split.finditer(text) if split else ():
                stream.extend([memory[w] for w in self._words.findall(text, at, m.start())])
                stream.append(~added[m.group()])
                at = m.end()
            stream.extend([memory[w] for w in self._words.findall(text[at:] if at else text)])
            ends.append(len(stream))
        memory.settle(self)
        number = np.array(stream, np.int64)
        plain = number >= 0
        counts = np.ones(len(number), np.int64)
        counts[plain] = memory.counts[number[plain]]
        bounds = np.concatenate([[0], np.cumsum(counts)])
        ids = np.empty(int(bounds[-1]), np.int32)
        ids[spread(bounds[:-1][plain], counts[plain])] = memory.ids[spread(memory.starts[number[plain]], counts[plain])]
        ids[bounds[:-1][~plain]] = ~number[~plain]
        text_bounds = bounds[np.concatenate([[0], ends]).astype(np.int64)]
        if len(memory) > REMEMBERED:
            del self._memory
        return text_bounds, ids

    def pre_tokens(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each text's pre-tokens: their characters, and their tokens. An added token is one of its own."""
        split, memory, found = self._parts[3], self._memory, []
        for text in texts:
            words, numbers, at = [], [], 0
            for m in (*(split.finditer(text) if split else ()), None):
                piece = self._words.findall(text[at : m.start()] if m else text[at:] if at else text)
                words += piece
                numbers += [memory[w] for w in piece]
                if m:
                    words.append(m.group())
                    numbers.append(-1)
                    at = m.end()
            found.append((np.fromiter(map(len, words), np.int64, len(words)), np.array(numbers, np.int64)))
        memory.settle(self)
        counts = np.append(memory.counts, 1)
        if len(memory) > REMEMBERED:
            del self._memory
        return [(lengths, counts[numbers]) for lengths, numbers in found]

    def split_from(self, text: str, at: int) -> Iterator[str]:
        """The pre-tokens from a pre-token's start to the end of a text without added tokens, one by one."""
        return (m.group() for m in self._words.finditer(text, at))

    def count_words(self, words: list[str]) -> list[int]:
        memory = self._memory
        numbers = [memory[w] for w in words]
        memory.settle(self)
        return memory.counts[numbers].tolist() if numbers else []

    def holds_added(self, text: str) -> bool:
        return any(t in text for t in self._parts[2])

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[1].tolist()

    @cached_property
    def _memory(self) -> _Memory:
        return _Memory()

    def decode(self, ids) -> str:
        """The text of the ids' bytes; bytes that are no UTF-8 become U+FFFD."""
        pieces = self._parts[4]
        return b"".join([pieces[i] for i in ids]).decode("utf-8", "replace")


def load(path: str) -> Codec:
    """Read a tokenizer file on the driver; tasks get its text, which is a few MB, by broadcast."""
    with open(path, encoding="utf-8") as f:
        return Codec(f.read())


def encode_documents(docs: DataFrame, codec: Codec, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep``, ``ids`` and ``decoded`` for every row: the whole text's token ids, and the text of those ids.

    A null or empty text has no ids and decodes to "". Special tokens in a text are themselves; none are added. What is
    kept passes through, nulls too; repeated rows come out repeated; other columns are not read, so they may have any
    name; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    plain = docs.select(F.struct(*keep).alias("row"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(codec)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec_ = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                bounds, ids = codec_.encode_all([t or "" for t in part.column("text").to_pylist()])
                pieces = zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
                texts = pa.array([codec_.decode(ids[a:b].tolist()) for a, b in pieces], pa.string())
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids))
                yield pa.RecordBatch.from_arrays([part.column("row"), lists, texts], ["row", "ids", "decoded"])

    fields = [plain.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return plain.mapInArrow(run, T.StructType(fields)).select("row.*", "ids", "decoded")
