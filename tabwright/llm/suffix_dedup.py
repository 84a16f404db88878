"""Removal of long repeats by a hash-compared suffix sort, dealt over tasks by content.

A byte goes if a string of ``length`` bytes that covers it also starts anywhere else. Strings of ``length`` bytes are
the heads of the corpus's suffixes, and two equal heads stand next to each other in its suffix array. The array is cut so
that equal heads always meet in one task:

* Every head names an anchor: its own run of ``seed_length`` bytes of the least hash, the first of equals. Equal heads
  name equal anchors at equal offsets, so a class (anchor, offset) holds all suffixes that can tie. Neighbouring heads
  mostly name the same anchor occurrence; they form one context, about 75 starts. An anchor that occurs once in the
  corpus needs no sort.
* Equal contexts (anchor and digest of the bytes, 128 bits) are counted before anything moves and stand in for each other.
  Of an anchor with only equal contexts, two or more, every head repeats. Where contexts differ, their suffixes are sorted.
* The sort is a bottom-up mergesort over all classes of a task at once. Suffixes are compared by prefix polynomial hashes:
  a binary search finds their common extension, the byte behind it decides. Neighbours whose heads tie are verified byte
  for byte; a collision of hashes means a new base and a new sort.
* An anchor with too many contexts for one task is dealt over several. Of its heads only those go on that can tie: heads
  of up to ``RANGE`` neighbouring offsets share a core of bytes, and a core that only one context holds settles them all.
  Each task then reports one digest for every distinct head it sorted, and heads that several tasks report repeat as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.llm.hot_keys import join_hot_apart, least_hot
from tabwright.llm.shipping import ship
from tabwright.llm.words import as_text, mix
from tabwright.session import materialise

PIECE = 1_000_000  # bytes that a task hashes at once; positions in a piece must fit 24 bits
CONTEXTS_A_TASK = 6_000
BLOCK = 512  # contexts of one anchor that are sorted in one task
RANGE = 8  # neighbouring offsets of an anchor whose heads are told apart by their core first
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the seed's odd base and of its inverse modulo 2**64."""
    if seed not in _POWERS or len(_POWERS[seed][0]) < n:
        base = int(mix(np.array([seed + 1], np.uint64))[0]) | 5
        _POWERS[seed] = tuple(np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(n - 1, b, np.uint64))]) for b in (base, pow(base, -1, 2**64)))
    return tuple(x[:n] for x in _POWERS[seed])


class PrefixHashes:
    """Polynomial hashes of all prefixes of ``data``, from which any substring's hash is one subtraction and one product."""

    def __init__(self, data: np.ndarray, seed: int = 0):
        letters = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(2 * seed + 1))
        power, self.inverse = _powers(len(data) + 1, seed)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(letters[data] * power[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, length) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.inverse[start]

    def all_of(self, length: int) -> np.ndarray:
        """The hash of every substring of ``length`` bytes, by start."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * self.inverse[:n]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1 : width - 1 + n])


def _bytes_of(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one array of bytes, and each text's bounds in it; null is empty."""
    texts = as_text(column)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = texts.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), bounds


def _pieces(bounds: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (text, first byte, end) of at most ``PIECE`` bytes; a longer text comes in overlapping pieces."""
    held, size = [], 0
    for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
        while b - a >= length:
            if size + min(b - a, PIECE) > PIECE:
                yield held
                held, size = [], 0
            end = min(b, a + PIECE)
            held.append((i, a, end))
            size += end - a
            if end == b:
                break
            a = end - length + 1
    if held:
        yield held


def contexts_of(data: np.ndarray, parts: list[tuple[int, int, int]], length: int, seed_length: int) -> dict[str, np.ndarray]:
    """The contexts of some stretches of bytes: text, first byte, end, the anchor's offset and hash, the digest of the bytes."""
    whole = np.concatenate([data[a:b] for _, a, b in parts])
    sizes = np.array([b - a for _, a, b in parts])
    base = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    grams = PrefixHashes(whole).all_of(seed_length)
    spread = mix(grams)
    place = np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_min(spread >> np.uint64(24) << np.uint64(24) | place, length - seed_length + 1) & np.uint64(0xFFFFFF)).astype(np.int64)
    heads = sizes - length + 1
    part = np.repeat(np.arange(len(parts)), heads)
    start = np.arange(len(part)) + np.repeat(base - np.concatenate([[0], np.cumsum(heads)[:-1]]), heads)
    anchor = anchor[start]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])]))
    last = np.concatenate([first[1:], [len(start)]]) - 1
    low, high, offset = start[first], start[last] + length, anchor[first] - start[first]
    view = memoryview(whole)
    digest = np.fromiter((xxhash.xxh3_64_intdigest(view[a:b], r) for a, b, r in zip(low.tolist(), high.tolist(), offset.tolist(), strict=True)), np.uint64, len(low))
    text, shift = np.array([p[0] for p in parts])[part[first]], (np.array([p[1] for p in parts]) - base)[part[first]]
    return {"text": text, "low": low + shift, "high": high + shift, "offset": offset, "h": spread[anchor[first]].view(np.int64), "g": digest.view(np.int64)}


def _digests(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """128 bits of every text, as two integers."""
    view = memoryview(data)
    both = b"".join(xxhash.xxh3_128_digest(view[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
    return np.frombuffer(both, np.int64).reshape(-1, 2)


_CONTEXT = "d1 long, d2 long, start long, size int, offset int, h long, g long"


def _anchored(length: int, seed_length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, bounds = _bytes_of(batch.column("text"))
            digests = _digests(data, bounds)
            for parts in _pieces(bounds, length):
                c = contexts_of(data, parts, length, seed_length)
                own = digests[c["text"]]
                columns = [own[:, 0], own[:, 1], c["low"] - bounds[c["text"]], (c["high"] - c["low"]).astype(np.int32), c["offset"].astype(np.int32), c["h"], c["g"]]
                yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in columns], ["d1", "d2", "start", "size", "offset", "h", "g"])

    return run


def _packed(once: bool):
    """Task: every text compressed, with its digest; ``once``: equal texts of a task only once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, seen = zstandard.ZstdCompressor(level=1), set()
        for batch in batches:
            data, bounds = _bytes_of(batch.column("text"))
            digests = _digests(data, bounds)
            rows = np.arange(batch.num_rows)
            if once:
                keys = [x.tobytes() for x in digests]
                rows = np.array([i for i, k in enumerate(keys) if not (k in seen or seen.add(k))], np.int64)
            view = memoryview(data)
            packed = pa.array([pack.compress(view[bounds[i] : bounds[i + 1]]) for i in rows.tolist()], pa.binary())
            columns = [pa.array(digests[rows, k]) for k in (0, 1)] + [pa.array((bounds[1:] - bounds[:-1])[rows]), packed]
            names = ["d1", "d2", "n_bytes", "packed"]
            if not once:
                columns, names = [batch.column("doc_id"), *columns], ["doc_id", *names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return run


def cores_of(piece: bytes, offset: int, length: int, seed_length: int) -> list[int | None]:
    """For each ``RANGE`` of offsets the hash of the bytes that a context's heads there have in common; None without any."""
    heads, out = len(piece) - length + 1, []
    for low in range(0, length - seed_length + 1, RANGE):
        high = min(low + RANGE, length - seed_length + 1) - 1
        here = low <= offset and high > offset - heads
        out.append(xxhash.xxh3_64_intdigest(piece[offset - low : offset - high + length]) - 2**63 if here else None)
    return out


_FIELDS = ["start", "offset", "h", "g", "copies", "salt", "cut", "task"]
_FETCHED = "d1 long, d2 long, start long, offset int, h long, g long, copies long, salt long, cut boolean, task int, bytes binary, cores array<long>"


def _cut_out(length: int, seed_length: int):
    """Task: the wanted contexts' bytes, cut from their texts, with the cores of those that are dealt over tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in range(0, batch.num_rows, 256):
                part = batch.slice(row, 256)
                wanted = part.column("wanted")
                counts = wanted.value_lengths().to_numpy()
                flat = wanted.flatten()
                start, size, offset, cut = (flat.field(n).to_pylist() for n in ("start", "size", "offset", "cut"))
                pieces, at = [], 0
                for packed, n, count in zip(part.column("packed").to_pylist(), part.column("n_bytes").to_pylist(), counts.tolist(), strict=True):
                    text = unpack.decompress(packed, max_output_size=n)
                    pieces.extend(text[a : a + b] for a, b in zip(start[at : at + count], size[at : at + count], strict=True))
                    at += count
                cores = [cores_of(p, o, length, seed_length) if c else [] for p, o, c in zip(pieces, offset, cut, strict=True)]
                own = pa.array(np.repeat(np.arange(part.num_rows), counts))
                columns = [part.column(n).take(own) for n in ("d1", "d2")] + [flat.field(n) for n in _FIELDS]
                columns += [pa.array(pieces, pa.binary()), pa.array(cores, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["d1", "d2", *_FIELDS, "bytes", "cores"])

    return run


def suffix_order(hashes: PrefixHashes, data: np.ndarray, start: np.ndarray, kind: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes at ``start`` sorted by (kind, first ``length`` bytes), and where one ties with the one before it.

    All kinds are merged at once, level by level: an element's place is its place in its own run plus its rank in the
    run beside it, found by binary search.
    """
    order = np.argsort(kind, kind="stable")
    kinds = kind[order]
    first = np.flatnonzero(np.concatenate([[True], kinds[1:] != kinds[:-1]])) if len(order) else np.zeros(0, np.int64)
    size = np.diff(np.concatenate([first, [len(order)]]))
    low, high = np.repeat(first, size), np.repeat(first + size, size)
    head = hashes.of(start, length)

    def less(a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix ``a`` comes before ``b``: by the byte behind their common extension."""
        out = or_equal.copy()
        differ = np.flatnonzero(head[a] != head[b])
        p, q = start[a[differ]], start[b[differ]]
        known, bound = np.zeros(len(p), np.int64), np.full(len(p), length - 1)
        while (known < bound).any():
            middle = (known + bound + 1) >> 1
            same = hashes.of(p, middle) == hashes.of(q, middle)
            known, bound = np.where(same, middle, known), np.where(same, bound, middle - 1)
        out[differ] = data[p + known] < data[q + known]
        return out

    width = 1
    while len(size) and width < size.max():
        at = np.flatnonzero((high - low) > width)
        local = at - low[at]
        run = low[at] + (local // (2 * width)) * (2 * width)
        in_left = local % (2 * width) < width
        middle, end = np.minimum(run + width, high[at]), np.minimum(run + 2 * width, high[at])
        begin = np.where(in_left, middle, run)
        a, b = begin.copy(), np.where(in_left, end, middle)
        while True:
            open_ = np.flatnonzero(a < b)
            if not len(open_):
                break
            m = (a[open_] + b[open_]) >> 1
            # The other run's element comes first if it is less, or ties and lies in the left run.
            goes = less(order[m], order[at[open_]], ~in_left[open_])
            a[open_] = np.where(goes, m + 1, a[open_])
            b[open_] = np.where(goes, b[open_], m)
        place = run + (at - np.where(in_left, run, middle)) + (a - begin)
        moved = order[at]
        order[place] = moved
        width *= 2
    ties = np.zeros(len(order), bool)
    ties[1:] = (kinds[1:] == kinds[:-1]) & (head[order[1:]] == head[order[:-1]])
    return order, ties


def _verified(data: np.ndarray, start: np.ndarray, order: np.ndarray, ties: np.ndarray, length: int, step: int = 20_000) -> bool:
    """Whether the bytes of all ties are equal."""
    at, reach = np.flatnonzero(ties), np.arange(length)
    for k in range(0, len(at), step):
        here = at[k : k + step]
        if (data[start[order[here]][:, None] + reach] != data[start[order[here - 1]][:, None] + reach]).any():
            return False
    return True


_FOUND = "d1 long, d2 long, low long, high long, w1 long, w2 long"


def _sorted(length: int):
    """Task: suffix-sorts the heads of its contexts and gives the stretches of bytes that repeat.

    A class that is dealt over several tasks also gives a digest for each distinct head: without a document if the head
    repeats here, else with the head's own place.
    """

    def run(table: pa.Table) -> pa.Table:
        frame = table.to_pandas().drop_duplicates(["h", "g"])  # a text may have come from several tasks
        pieces = frame["bytes"].tolist()
        data = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        base = np.cumsum(sizes) - sizes
        heads = sizes - length + 1
        owner = np.repeat(np.arange(len(pieces)), heads)
        inner = np.arange(len(owner)) - np.repeat(np.cumsum(heads) - heads, heads)
        # Of contexts that are dealt over tasks, the heads whose core another context holds.
        live = np.zeros((len(pieces), length // RANGE + 1), bool)
        for i, ranges in enumerate(frame["live"]):
            live[i, slice(None) if ranges is None else ranges] = True
        kept = live[owner, (frame["offset"].to_numpy()[owner] - inner) // RANGE]
        owner, inner = owner[kept], inner[kept]
        start = base[owner] + inner
        group = frame.groupby(["h", "salt"], sort=False).ngroup().to_numpy()
        kind = group[owner] * (2 * length) + (frame["offset"].to_numpy()[owner] - inner)
        seed = 0
        while True:
            order, ties = suffix_order(PrefixHashes(data, seed), data, start, kind, length)
            if _verified(data, start, order, ties, length):
                break
            seed += 1
        of = np.cumsum(~ties) - 1
        copies = np.bincount(of, weights=frame["copies"].to_numpy()[owner[order]])
        repeats = np.zeros(len(order), bool)
        repeats[order] = copies[of] > 1
        single = frame["copies"].to_numpy() == 1  # contexts with copies are known to repeat
        hit = np.flatnonzero(repeats & single[owner])
        new = np.concatenate([[True], (inner[hit[1:]] != inner[hit[:-1]] + 1) | (owner[hit[1:]] != owner[hit[:-1]])]) if len(hit) else np.zeros(0, bool)
        a = hit[new]
        b = hit[np.concatenate([new[1:], [True]])] if len(hit) else hit
        d1, d2, at = (frame[c].to_numpy() for c in ("d1", "d2", "start"))
        rows = [d1[owner[a]], d2[owner[a]], at[owner[a]] + inner[a], at[owner[a]] + inner[b] + length]
        columns = [pa.array(x, pa.int64()) for x in rows] + [pa.nulls(len(a), pa.int64())] * 2
        found = pa.Table.from_arrays(columns, ["d1", "d2", "low", "high", "w1", "w2"])
        leader = order[~ties]
        leader = leader[frame["cut"].to_numpy()[owner[leader]]]
        if len(leader):
            view = memoryview(data)
            marks = np.frombuffer(b"".join(xxhash.xxh3_128_digest(view[p : p + length]) for p in start[leader].tolist()), np.int64).reshape(-1, 2)
            settled = pa.array(repeats[leader])
            places = [d1[owner[leader]], d2[owner[leader]], at[owner[leader]] + inner[leader], at[owner[leader]] + inner[leader] + length]
            columns = [pa.compute.if_else(settled, None, pa.array(x, pa.int64())) for x in places]
            columns += [pa.array(np.ascontiguousarray(marks[:, k])) for k in (0, 1)]
            found = pa.concat_tables([found, pa.Table.from_arrays(columns, found.column_names)])
        return found

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: unites the stretches of each text and cuts them out."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        for row in range(0, batch.num_rows, 256):
            part = batch.slice(row, 256)
            spans, kept = [], []
            for packed, n, whole, found in zip(*(part.column(c).to_pylist() for c in ("packed", "n_bytes", "whole", "found")), strict=True):
                text = unpack.decompress(packed, max_output_size=n) if n else b""
                own: list[dict] = []
                for low, high in [(0, n)] if whole else sorted((x["low"], x["high"]) for x in found or ()):
                    if own and low <= own[-1]["end"]:
                        own[-1]["end"] = max(own[-1]["end"], high)
                    else:
                        own.append({"start": low, "end": high})
                edges = [0, *(x for s in own for x in (s["start"], s["end"])), n]
                spans.append(own)
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            removed = [n - len(k) for n, k in zip(part.column("n_bytes").to_pylist(), kept, strict=True)]
            columns = [part.column("doc_id"), part.column("n_bytes"), pa.array(removed, pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_removed", "spans", "kept"])


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, length: int = 200, seed_length: int = 48, block: int = BLOCK
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, spans, kept)``, one row for every row of ``docs``.

    A text is its UTF-8 bytes. ``spans`` are the maximal stretches ``(start, end)`` that strings of ``length`` bytes
    cover which start at another place as well, in the same text or another one; ``kept`` are the other bytes, joined.
    Strings never cross texts and are judged on the texts as given. A cut may fall inside a character, so ``kept`` is
    binary. A null or empty text has no bytes; a text shorter than ``length`` stays whole. Equal texts, repeated rows and
    rows that share an id are separate rows that repeat each other, whatever their ids; a row without an id counts like
    any other. Other columns are not read; an empty table gives no rows. ``seed_length`` moves work between the first
    pass and the sort and never changes the result.
    """
    if not 0 < seed_length <= length:
        raise ValueError("seed_length must lie between 1 and length")
    spark = docs.sparkSession
    ship(spark)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    texts = plain.select("text")
    anchored = materialise(texts.mapInArrow(_anchored(length, seed_length), _CONTEXT), "contexts")
    times = anchored.groupBy("h").agg(F.count("*").alias("times"), F.min("g").alias("least"), F.max("g").alias("most")).where("times > 1")
    times = materialise(times.select("h", "times", (F.col("least") != F.col("most")).alias("mixed")), "anchors")
    total = anchored.count()
    repeated = materialise(join_hot_apart(anchored, times, ["h"], "times", total), "repeated")
    mixed = repeated.where("mixed")
    place = F.min(F.struct("d1", "d2", "start", "size", "offset")).alias("at")
    kinds = materialise(mixed.groupBy("h", "g").agg(F.count("*").alias("copies"), F.first("times").alias("times"), place), "kinds")

    # Suffix sort of contexts that differ.
    tasks = max(1, -(-kinds.count() // CONTEXTS_A_TASK))
    parts = F.ceil(F.col("times") / block)
    dealt = kinds.select("h", "g", "copies", "at.*", (parts > 1).alias("cut"), F.pmod(F.xxhash64("g"), parts).alias("salt"))
    dealt = dealt.withColumn("task", F.pmod(F.xxhash64("h", "salt"), F.lit(tasks)).cast("int"))
    wanted = dealt.groupBy("d1", "d2").agg(F.collect_list(F.struct("start", "size", "offset", "h", "g", "copies", "salt", "cut", "task")).alias("wanted"))
    held = texts.mapInArrow(_packed(once=True), "d1 long, d2 long, n_bytes long, packed binary").join(wanted, ["d1", "d2"])
    fetched = materialise(held.mapInArrow(_cut_out(length, seed_length), _FETCHED), "fetched")
    marks = fetched.where("cut").select("h", "g", F.posexplode("cores").alias("range", "core")).where("core is not null")
    cores = marks.groupBy("h", "range", "core").agg(F.count("*").alias("times"), F.min("g").alias("least"), F.max("g").alias("most"))
    cores = materialise(cores.where("least != most").select("h", "range", "core", "times"), "cores")
    shared = join_hot_apart(marks, cores, ["h", "range", "core"], "times", marks.count())
    live = shared.groupBy("h", "g").agg(F.collect_set("range").alias("live"))
    sent = fetched.drop("cores").where("not cut").withColumn("live", F.lit(None).cast("array<int>"))
    sent = sent.unionByName(fetched.drop("cores").where("cut").join(live, ["h", "g"]))
    found = materialise(sent.groupBy("task").applyInArrow(_sorted(length), _FOUND), "found")
    heads = found.where("w1 is not null")
    twice = heads.groupBy("w1", "w2").agg(F.count("*").alias("tasks")).where("tasks > 1")
    across = heads.where("d1 is not null").join(twice, ["w1", "w2"], "left_semi")

    # Texts that are very frequent repeat as a whole; they are told apart by a table of bounded size.
    times_a_text = anchored.where("start = 0").groupBy("d1", "d2").agg(F.count("*").alias("times"))
    often = materialise(times_a_text.where(F.col("times") >= least_hot(total)).select("d1", "d2", F.lit(True).alias("whole")), "often")
    reach = (F.col("start") + F.col("size")).alias("high")
    known = kinds.where("copies > 1").select("h", "g", "copies")
    stretches = (
        repeated.where("not mixed").select("d1", "d2", F.col("start").alias("low"), reach)
        .union(join_hot_apart(mixed, known, ["h", "g"], "copies", total).select("d1", "d2", F.col("start").alias("low"), reach))
        .union(found.where("w1 is null").select("d1", "d2", "low", "high"))
        .union(across.select("d1", "d2", "low", "high"))
    )
    stretches = stretches.join(F.broadcast(often), ["d1", "d2"], "left_anti")
    covered = stretches.groupBy("d1", "d2").agg(F.collect_set(F.struct("low", "high")).alias("found"))
    id_type = plain.schema["doc_id"].dataType.simpleString()
    rows = plain.mapInArrow(_packed(once=False), f"doc_id {id_type}, d1 long, d2 long, n_bytes long, packed binary")
    rows = rows.join(F.broadcast(often), ["d1", "d2"], "left")
    # Copies of a very frequent text look for nothing, so each goes to a place of its own.
    own = F.coalesce(F.xxhash64("doc_id"), F.lit(0))
    rows = rows.withColumns({"d1": F.when(F.col("whole"), own).otherwise(F.col("d1")), "d2": F.when(F.col("whole"), F.lit(0)).otherwise(F.col("d2"))})
    out = "doc_id " + id_type + ", n_bytes long, n_removed long, spans array<struct<start: long, end: long>>, kept binary"
    return rows.join(covered, ["d1", "d2"], "left").select("doc_id", "n_bytes", "packed", "whole", "found").mapInArrow(_kept, out)
