"""Exact top-k search by inner product, block at a time.

Vectors are cut into blocks of near range: sorted by their largest and smallest component, then ``block`` at a time. A
block keeps its components' maxima and minima beside its forward index, the vectors themselves. A query bounds a block's
best score by summing, component by component, the larger product; it visits blocks from the highest bound down and stops
where the bound falls below its k-th score. Blocks and queries meet in cells of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm.shipping import ship
from tabwright.session import materialise

EXACT = 1 << 53


def quantised(column: Column, scale: int = 64) -> Column:
    """``floor(scale * x)`` of every component; null for a null vector or one with a null or non-finite component."""
    wide = F.transform(column, lambda x: x.cast("double"))
    finite = F.forall(wide, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.when(finite, F.transform(wide, lambda x: F.floor(x * scale)))


def _matrix(rows: pa.Array, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), np.int64)
    for i, x in enumerate(rows.to_pylist()):
        out[i, : len(x)] = x
    return out


def _blocks(block: int, width: int):
    """Task: cut the partition's vectors, in their order, into blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                part = batch.slice(at, block)
                ids, vectors = part.column("vec_id").to_numpy(zero_copy_only=False), _matrix(part.column("vector"), width)
                yield pa.RecordBatch.from_pydict({"group": [group], "ids": [ids.tolist()], "vectors": [vectors.tobytes()], "high": [vectors.max(axis=0).tobytes()], "low": [vectors.min(axis=0).tobytes()]})

    return run


def _floors(sample: np.ndarray, sample_ids: np.ndarray, k: int, width: int):
    """Task: a score that each query's k-th best surely reaches, from a sample of all vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        repeated = len(np.unique(sample_ids)) < len(sample_ids)
        for batch in batches:
            ids, vectors = batch.column("vec_id").to_numpy(zero_copy_only=False), _matrix(batch.column("vector"), width)
            floors = np.full(len(ids), np.iinfo(np.int64).min)
            for i, (own, v) in enumerate(zip(ids, vectors, strict=True)):
                others = _products(sample, v)[sample_ids != own]
                if repeated:  # an id counts once, by its best vector
                    order = np.argsort(-others, kind="stable")
                    others = others[order][np.unique(sample_ids[sample_ids != own][order], return_index=True)[1]]
                if len(others) >= k:
                    floors[i] = np.partition(others, len(others) - k)[len(others) - k]
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array([v.tobytes() for v in vectors], pa.binary()), pa.array(floors)], ["vec_id", "vector", "floor"])

    return run


def _products(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products: in doubles where no sum can leave their exact range."""
    if not vectors.size:
        return np.zeros(len(vectors), np.int64)
    if int(np.abs(vectors).max()) * int(np.abs(query).max()) * len(query) < EXACT:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    return vectors @ query


def search_cell(queries: list[tuple[int, np.ndarray, int]], blocks: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """Each query's best ``k`` among the blocks that can reach its floor: its id, their ids and scores, blocks visited."""
    high, low = (np.stack([b[x] for b in blocks]) for x in (2, 3))
    all_ids = np.concatenate([b[0] for b in blocks])
    repeated = len(np.unique(all_ids)) < len(all_ids)
    safe = all(int(np.abs(b[1]).max(initial=0)) < 1 << 24 for b in blocks)
    wide = [b[1].astype(np.float64) for b in blocks] if safe else None
    for own, query, floor in queries:
        bound = np.where(query > 0, high * query, low * query).sum(axis=1)
        best_ids, best, least, visited = np.zeros(0, np.int64), np.zeros(0, np.int64), floor, 0
        small = safe and int(np.abs(query).max(initial=0)) < 1 << 20
        for b in np.argsort(-bound, kind="stable").tolist():
            if bound[b] < least:
                break
            visited += 1
            ids, vectors = blocks[b][:2]
            scores = (wide[b] @ query.astype(np.float64)).astype(np.int64) if small else _products(vectors, query)
            kept = (scores >= least) & (ids != own)
            if not kept.any():
                continue
            best_ids, best = np.concatenate([best_ids, ids[kept]]), np.concatenate([best, scores[kept]])
            order = np.lexsort((best_ids, -best))
            if repeated:  # an id counts once, by its best vector
                order = order[np.sort(np.unique(best_ids[order], return_index=True)[1])]
            order = order[:k]
            best_ids, best = best_ids[order], best[order]
            if len(best) == k:
                least = max(least, int(best[-1]))
        yield own, best_ids, best, visited


def _searched(k: int):
    """Task: one cell, some blocks and some queries."""

    def run(blocks: pa.Table, queries: pa.Table) -> pa.Table:
        asked = [(q["vec_id"], np.frombuffer(q["vector"], np.int64), q["floor"]) for q in queries.select(["vec_id", "vector", "floor"]).to_pylist()]
        held = []
        for b in blocks.select(["ids", "vectors", "high", "low"]).to_pylist():
            ids = np.array(b["ids"], np.int64)
            held.append((ids, np.frombuffer(b["vectors"], np.int64).reshape(len(ids), -1), np.frombuffer(b["high"], np.int64), np.frombuffer(b["low"], np.int64)))
        found = list(search_cell(asked, held, k)) if held and asked else []
        return pa.table({
            "query_id": pa.array(np.repeat([f[0] for f in found], [len(f[1]) for f in found]).astype(np.int64) if found else [], pa.int64()),
            "vec_id": pa.array(np.concatenate([f[1] for f in found]) if found else [], pa.int64()),
            "score": pa.array(np.concatenate([f[2] for f in found]) if found else [], pa.int64()),
        })

    return run


def top_k(vectors: DataFrame, queries: Column, id_col: str = "vec_id", vector_col: str = "embedding", *, k: int = 20, scale: int = 64, block: int = 512, blocks_per_cell: int = 64, queries_per_cell: int = 1024, sample: int = 4096) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best other vectors of every row that ``queries`` selects.

    Scores are integer inner products of ``floor(scale * x)``; ties go to the smaller id; fewer than ``k`` others give
    fewer rows. Vectors that are null, or hold null or non-finite components, and rows without an id take no part.
    Shorter vectors count as padded with zeros. Rows that repeat an id and its vector count once; rows of one id are
    never each other's results. Other columns are not read. An empty table gives no rows. Where the square of the largest
    scaled component times the width passes 64 bits, scores could; such a table is refused.
    """
    spark = vectors.sparkSession
    ship(spark)
    rows = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("vec_id"), quantised(F.col(vector_col), scale).alias("vector"), queries.alias("asks"))
    rows = materialise(rows.where("vector is not null").dropDuplicates(["vec_id", "vector"]), "vectors")
    reach = F.greatest(F.max(F.array_max("vector")), -F.min(F.array_min("vector")))
    total, width, asking, largest = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0)), F.count_if("asks"), F.coalesce(reach, F.lit(0))).first()
    width = max(1, width)
    if largest**2 * width >= 1 << 63:
        raise ValueError("inner products may leave the range of 64-bit integers")
    per_cell = block * blocks_per_cell
    cells = max(1, -(-total // per_cell))
    spread = rows.repartitionByRange(cells, F.array_position("vector", F.array_max("vector")), F.array_position("vector", F.array_min("vector")), "vec_id")
    ordered = spread.sortWithinPartitions(F.array_position("vector", F.array_max("vector")), F.array_position("vector", F.array_min("vector")), "vec_id")
    blocks = materialise(ordered.mapInArrow(_blocks(block, width), "group bigint, ids array<bigint>, vectors binary, high binary, low binary"), "blocks")
    seen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("vec_id", "vector").toArrow()  # at most sample rows
    floors = _floors(_matrix(seen.column("vector").combine_chunks(), width), seen.column("vec_id").to_numpy(), k, width)
    asked = rows.where("asks").select("vec_id", "vector").mapInArrow(floors, "vec_id bigint, vector binary, floor bigint")
    query_groups = max(1, -(-asking // queries_per_cell))
    asked = materialise(asked.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(query_groups))), "queries")
    # The stated queries against all rows: every query group meets every block group once.
    block_side = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_groups - 1)).cast("array<bigint>")))
    query_side = asked.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(cells - 1)).cast("array<bigint>")))
    found = block_side.groupBy("group", "part").cogroup(query_side.groupBy("group", "part")).applyInArrow(_searched(k), "query_id bigint, vec_id bigint, score bigint")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return best.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", F.col("rank").cast(T.IntegerType()).alias("rank"), "vec_id", "score")
