"""MinHash near-duplicates by a chosen-path set similarity join.

A document is the set of its distinct word shingles. Documents of equal sets fall into one class first, so copies cost
one row each. A class then walks down ``trees`` independent trees: at a node it is sent on along two minwise tokens of
the node's own (a coordinate and the class's smallest hash there), and so meets only classes that share them. A node
of few classes, at any level, is a leaf: its full sets are compared exhaustively. A node that is still large at the last
level is compared in blocks of bounded size. Each comparison reports a spanning forest of the links it found, never all
pairs.

No two places of a tree and no two trees share a coordinate, so a pair's chances multiply. Two sets of similarity s
meet on some path of d levels with chance q(d) = 1 - (1 - s q(d - 1))**2, q(0) = 1, and four trees miss them with chance
(1 - q(d))**4: at s = 0.8, 1 in 390,000 if their nodes are leaves at the first level, 1 in 120,000 at the second and 1 in
81,000 at the third. Before a leaf's sets are read, its pairs are screened on all their smallest hashes, with a bound that
loses a pair at the wanted similarity with a chance under one in a billion; sets of up to 64 shingles are not screened.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm import words
from tabwright.llm.components import components
from tabwright.llm.shipping import ship
from tabwright.session import materialise

SCREEN_LOSS = 1e-9
UNSCREENED = 64  # sets of so many shingles are short to read, and too short for a screen
UNIT_SHINGLES = 1_000_000  # about as many shingles as two blocks hold each
ROWS_AT_ONCE = 2_000


def _sets(texts: pa.ChunkedArray, width: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    bounds, values = words.distinct_sets(*words.hash_shingles(words.as_text(texts), width))
    pairs = zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
    return bounds, values, [xxhash.xxh3_128_digest(values[a:b].tobytes()) if b > a else None for a, b in pairs]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def _per_tree(depth: int) -> int:
    """Coordinates of a tree: two for the root and for every node above the last level, numbered as in a heap."""
    return 2 ** (depth + 1) - 2


def _sketched(width: int, coordinates: int):
    """Task: a document's set size, its set's digest, and its smallest hash in every coordinate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors = (words.odd_factors(coordinates, 77) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        for batch in _pieces(batches):
            bounds, values, digests = _sets(batch.column("text"), width)
            full = np.diff(bounds) > 0
            low = (values >> np.uint64(32)).astype(np.uint32)
            mins = np.zeros((batch.num_rows, coordinates), np.uint32)
            for k in range(coordinates if full.any() else 0):
                spread = (low ^ np.uint32(k * 0x9E3779B1 & 0xFFFFFFFF)) * factors[k]
                spread ^= spread >> np.uint32(15)
                spread *= np.uint32(0x2C1B3C6D)
                mins[full, k] = np.minimum.reduceat(spread, bounds[:-1][full])
            lists = pa.FixedSizeListArray.from_arrays(pa.array(mins.view(np.int32).ravel()), coordinates).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(bounds)), pa.array(digests, pa.binary()), lists],
                ["doc_id", "n_shingles", "digest", "mins"],
            )

    return run


def _set_bytes(width: int):
    """Task: a document's whole set, for documents whose set has the wanted digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches):
            bounds, values, digests = _sets(batch.column("text"), width)
            wanted = batch.column("digest").to_pylist()
            kept = [i for i, (have, want) in enumerate(zip(digests, wanted, strict=True)) if have == want]
            members = [values[bounds[i] : bounds[i + 1]].tobytes() for i in kept]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(kept, pa.int64())), pa.array([wanted[i] for i in kept], pa.binary()), pa.array(members, pa.binary())],
                ["doc_id", "digest", "members"],
            )

    return run


def shared_counts(sets: list[np.ndarray], step: int = 8192) -> np.ndarray:
    """How many values every two sets share, over slices of the values that at least two sets hold."""
    sizes = [len(s) for s in sets]
    values, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.cumsum(times > 1) - 1
    keep = times[at] > 1
    column, row = order[at[keep]], np.repeat(np.arange(len(sets)), sizes)[keep]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    by = np.argsort(column, kind="stable")
    column, row = column[by], row[by]
    total = int(order[-1]) + 1 if len(order) else 0
    for low in range(0, total, step):
        a, b = np.searchsorted(column, [low, low + step])
        held = np.zeros((len(sets), min(step, total - low)), np.float32)
        held[row[a:b], column[a:b] - low] = 1
        shared += held @ held.T
    np.fill_diagonal(shared, sizes)
    return shared


def _forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges that connect whatever the link matrix connects."""
    left, edges = np.ones(len(linked), bool), []
    for root in range(len(linked)):
        if not left[root]:
            continue
        left[root] = False
        front = [root]
        while front:
            x = front.pop()
            for y in np.flatnonzero(linked[x] & left).tolist():
                left[y] = False
                edges.append((x, y))
                front.append(y)
    return edges


def least_shared(coordinates: int, percent: int) -> int:
    """The most coordinates that two sets of the wanted similarity lack with a chance under ``SCREEN_LOSS``."""
    p, under, least = percent / 100, 0.0, 0
    while least < coordinates:
        under += math.comb(coordinates, least) * p**least * (1 - p) ** (coordinates - least)
        if under >= SCREEN_LOSS:
            break
        least += 1
    return least


def _screened(percent: int):
    """Task: the classes of a leaf that may be linked to another one there, by sizes and by smallest hashes."""

    def run(table: pa.Table) -> pa.Table:
        sizes = table.column("n_shingles").to_numpy()
        marks = table.column("marks").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(sizes), -1)
        shared = np.zeros((len(sizes), len(sizes)), np.int16)
        for k in range(marks.shape[1]):
            shared += marks[:, k, None] == marks[None, :, k]
        small, large = np.minimum(sizes[:, None], sizes), np.maximum(sizes[:, None], sizes)
        likely = (100 * small >= percent * large) & ((shared >= least_shared(marks.shape[1], percent)) | (small <= UNSCREENED))
        np.fill_diagonal(likely, False)
        kept = np.flatnonzero(likely.any(axis=1))
        left = table.select(["node", "digest"]).take(pa.array(kept))
        size, total = np.full(len(kept), len(kept)), np.full(len(kept), sizes[kept].sum())
        return left.append_column("size", pa.array(size, pa.int64())).append_column("total", pa.array(total, pa.int64()))

    return run


def _compared(percent: int):
    """Task: a spanning forest of the links among the full sets of one leaf or pair of blocks."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("doc_id").combine_chunks()
        sets = [np.frombuffer(x, np.uint64) for x in table.column("members").to_pylist()]
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        both = shared_counts(sets).astype(np.int64)
        edges = _forest(100 * both >= percent * (sizes[:, None] + sizes[None, :] - both))
        a, b = (pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1))
        return pa.table({"a": ids.take(a), "b": ids.take(b)})

    return run


def _meeting(rows: DataFrame) -> DataFrame:
    """Rows of nodes that at least two classes reach, with the node's classes and shingles."""
    sizes = rows.groupBy("node").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("total")).where("size > 1")
    return materialise(rows.join(sizes, "node"), "tree")


def _step(node: F.Column, at: F.Column) -> F.Column:
    return F.struct(F.xxhash64(node, at, F.get("mins", at)).alias("node"), at.alias("at"))


def _leaves(classes: DataFrame, trees: int, depth: int, leaf: int, block: int, percent: int) -> DataFrame:
    """``(unit, digest)``: classes to compare with each other, each unit of bounded size."""
    per_tree = _per_tree(depth)
    first = [_step(F.lit(0), F.lit(t * per_tree + c)) for t in range(trees) for c in (0, 1)]
    rows = _meeting(classes.select(F.inline(F.array(*first)), "digest", "n_shingles"))
    units, small = [], (F.col("size") <= leaf) & (F.col("total") <= UNIT_SHINGLES)
    marks = classes.select("digest", F.transform("mins", lambda x: x.bitwiseAND(127).cast("byte")).alias("marks"))  # enough to tell them apart
    for level in range(1, depth + 1):
        leaves = rows.where(small).select("node", "digest", "n_shingles").join(marks, "digest").groupBy("node")
        units.append(leaves.applyInArrow(_screened(percent), "node long, digest binary, size long, total long"))
        rows = rows.where(~small)
        if level == depth:
            units.append(rows.select("node", "digest", "size", "total"))
        elif rows.isEmpty():
            break
        else:
            sent = rows.select("node", "at", "digest", "n_shingles").join(classes.select("digest", "mins"), "digest")
            below = F.col("at") + F.pmod(F.col("at"), F.lit(per_tree)) + 2  # the first of the node's two coordinates
            rows = _meeting(sent.select(F.inline(F.array(_step(F.col("node"), below), _step(F.col("node"), below + 1))), "digest", "n_shingles"))
    nodes = units[0]
    for more in units[1:]:
        nodes = nodes.union(more)
    nodes = materialise(nodes, "leaves")
    # Several trees often gather the very same classes: compare them once.
    held = nodes.groupBy("node").agg(F.first("size").alias("size"), F.first("total").alias("total"), *(F.bit_xor(F.xxhash64("digest", F.lit(k))).alias(f"x{k}") for k in (0, 1)))
    once = held.groupBy("x0", "x1", "size").agg(F.min("node").alias("node")).select("node")
    blocks = F.greatest(F.ceil(F.col("size") / block), F.ceil(F.col("total") / UNIT_SHINGLES)).cast("int")
    own = F.pmod(F.xxhash64("digest", F.lit("block")), blocks).cast("int")
    parts = nodes.join(once, "node").select("node", "digest", small.alias("small"), own.alias("own"), F.explode(F.when(small, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), blocks - 1))).alias("other"))
    unit = F.when(F.col("small"), F.col("node")).otherwise(F.xxhash64("node", F.least("own", "other"), F.greatest("own", "other")))
    return materialise(parts.select(unit.alias("unit"), "digest"), "units")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    *,
    width: int = 5,
    percent: int = 80,
    trees: int = 4,
    depth: int = 3,
    leaf: int = 512,
    block: int = 768,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``, one row for every row of ``docs``.

    Two documents are linked if 100 * shared >= ``percent`` * united of their shingle sets, confirmed on the full sets;
    a component's id is the smallest id that links reach, and ``kept`` marks the document of that id. A text of fewer
    than ``width`` words is one shingle; a null, empty or blank text has none, is linked with nothing and stays its own
    component. A row without an id is linked with nothing: its component is null and it is not kept. Rows that share an
    id count as one document. Repeated rows come out repeated. Other columns are not read; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = plain.schema["doc_id"].dataType
    fields = [T.StructField("doc_id", id_type), T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType())]
    mins = T.StructField("mins", T.ArrayType(T.IntegerType()))
    sketches = materialise(plain.mapInArrow(_sketched(width, trees * _per_tree(depth)), T.StructType([*fields, mins])), "sketches")
    usable = sketches.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    owners = materialise(usable.groupBy("digest").agg(F.min("doc_id").alias("owner")), "owners")
    same = (F.col("s.digest") == F.col("o.digest")) & (F.col("s.doc_id") == F.col("o.owner"))
    classes = usable.alias("s").join(owners.alias("o"), same, "left_semi").dropDuplicates(["digest"])
    classes = materialise(classes, "classes")

    units = _leaves(classes, trees, depth, leaf, block, percent)
    wanted = classes.join(units.select("digest").distinct(), "digest").select("doc_id", "digest")
    texts = plain.join(wanted, "doc_id").select("doc_id", "digest", "text")
    members = T.StructType([fields[0], fields[2], T.StructField("members", T.BinaryType())])
    sets = materialise(texts.mapInArrow(_set_bytes(width), members).dropDuplicates(["digest"]), "sets")
    link = T.StructType([T.StructField("a", id_type), T.StructField("b", id_type)])
    gathered = units.join(sets, "digest").select("unit", "doc_id", "members")
    links = gathered.groupBy("unit").applyInArrow(_compared(percent), link)
    # Owners stand for their classes; ids that own several classes, or repeat with other texts, tie those together.
    ties = usable.join(owners, "digest").where(F.col("doc_id") != F.col("owner"))
    repeated = usable.groupBy("doc_id").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).where("least != most").select("doc_id")
    ties = ties.join(repeated, "doc_id").select(F.col("doc_id").alias("a"), F.col("owner").alias("b"))
    found = components(links.union(ties))
    named = owners.join(found, F.col("owner") == F.col("vertex"), "left").select("digest", F.coalesce("component", "owner").alias("root"))
    out = sketches.select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, whole, less those whose component keeps another document.

    Of rows that share an id the one of the smallest digest stays, whatever their order. Rows without an id stay, all of
    them; null, empty and blank texts are nobody's copy. All columns stay, whatever their names; an empty table gives no rows.
    """
    marks = near_duplicates(docs, id_col, text_col, **options).where("doc_id is not null")
    marks = materialise(marks.groupBy(F.col("doc_id").alias("_id")).agg(F.count("*").alias("_times"), F.bool_or("kept").alias("_kept")).where("not _kept or _times > 1"), "marks")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    joined = rows.join(marks, F.col("row")[id_col] == marks["_id"], "left").where(F.coalesce("_kept", F.lit(True)))
    if marks.where("_kept").isEmpty():
        return joined.select("row.*")
    once = joined.where("_times > 1").groupBy("_id").agg(F.min_by("row", F.md5(F.to_json("row"))).alias("row"))
    return joined.where("_times is null").select("row").union(once.select("row")).select("row.*")
