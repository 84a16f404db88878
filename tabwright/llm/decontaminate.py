"""Benchmark decontamination: size-partitioned MinHash containment search, verified on full shingle sets.

An item leaks into a document if the document holds at least ``percent`` per cent of the item's distinct word shingles.
The index is over the items. They are partitioned by the size of their shingle sets, and the items of a partition are
sketched by their k smallest shingle hashes, k being the partition's own: just over the share an item may miss of the
partition's largest size. Of a contained item at least one sketch hash therefore occurs in the document, wherever its
passages stand, so the search loses nothing. Documents look up all their shingles, whole texts at once, in the table of
sketch hashes; whatever is found is verified by counting the item's shingles in the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tabwright.llm import words
from tabwright.llm.shipping import ship
from tabwright.session import materialise

ROWS_AT_ONCE = 1_000


def _item_rows(width: int):
    """Task: every distinct shingle of an item's row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bounds, values = words.distinct_sets(*words.hash_shingles(words.as_text(batch.column("text")), width))
            ids = batch.column("item_id").take(pa.array(np.repeat(np.arange(batch.num_rows), np.diff(bounds))))
            yield pa.RecordBatch.from_arrays([ids, pa.array(values.view(np.int64))], ["item_id", "shingle"])

    return run


def _document_rows(width: int, wanted):
    """Task: the distinct shingles of a document that some item holds, for documents that a sketch hash occurs in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, sketched = wanted.value
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(low, ROWS_AT_ONCE)
                bounds, found = words.hash_shingles(words.as_text(part.column("text")), width)
                at = np.searchsorted(values, found)
                at[at == len(values)] = 0
                hit = np.flatnonzero(values[at] == found) if len(values) else np.zeros(0, np.int64)
                doc = np.searchsorted(bounds, hit, side="right") - 1
                pairs = np.unique(np.stack([doc, at[hit]]), axis=1) if len(hit) else np.zeros((2, 0), np.int64)
                candidate = np.zeros(part.num_rows, bool)
                candidate[pairs[0][sketched[pairs[1]]]] = True
                doc, at = pairs[:, candidate[pairs[0]]]
                yield pa.RecordBatch.from_arrays(
                    [part.column("_row").take(pa.array(doc)), pa.array(values[at].view(np.int64))], ["_row", "shingle"]
                )

    return run


def _all_document_rows(width: int):
    """Task: every distinct shingle of a document, for item tables too large to send whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(low, ROWS_AT_ONCE)
                bounds, values = words.distinct_sets(*words.hash_shingles(words.as_text(part.column("text")), width))
                rows = pa.array(np.repeat(np.arange(part.num_rows), np.diff(bounds)))
                yield pa.RecordBatch.from_arrays([part.column("_row").take(rows), pa.array(values.view(np.int64))], ["_row", "shingle"])

    return run


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    *,
    width: int = 5,
    percent: int = 80,
    sent_shingles: int = 2_000_000,
) -> DataFrame:
    """``(doc_id, mark, item_id, shared, item_size)`` for every item that leaks into a document.

    ``mark`` is a digest of the document's text.
    Items of fewer than ``width`` words are one shingle, their whole sequence, and leak into documents of that very
    sequence only; null, empty or blank texts on either side match nothing. A null id on either side is kept like any
    other value. Rows that share a document id are told apart by their texts, and rows of one id and text are reported
    once; rows that share an item id are one item, its shingles united. Other columns are not read. Item tables of more
    than ``sent_shingles`` distinct shingles (16 bytes each) are not sent to the tasks: sketch hashes are then joined.
    """
    spark = docs.sparkSession
    ship(spark)
    plain = docs.select(F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("mark")).alias("_row"), F.col(text_col).alias("text"))
    kind = plain.schema["_row"].dataType.simpleString()
    wanted = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))
    item_kind = wanted.schema["item_id"].dataType.simpleString()
    united = wanted.mapInArrow(_item_rows(width), f"item_id {item_kind}, shingle bigint").distinct()
    # Partitions are sizes of one number of binary digits, sketched by what the largest size of theirs may lack, and one.
    own = Window.partitionBy("item_id")
    ranked = united.select("*", F.count("*").over(own).alias("item_size"), F.row_number().over(own.orderBy("shingle")).alias("rank"))
    top = F.expr("shiftleft(1L, length(bin(item_size)))") - 1
    sketch = F.floor(top * (100 - percent) / 100) + 1
    index = materialise(ranked.select("item_id", "shingle", (F.col("rank") <= sketch).alias("sketched")), "items")
    sizes = index.groupBy("item_id").agg(F.count("*").alias("item_size"))
    if index.count() <= sent_shingles:
        table = index.groupBy("shingle").agg(F.bool_or("sketched").alias("sketched")).toPandas()  # at most sent_shingles rows
        values = table["shingle"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(values)
        sent = spark.sparkContext.broadcast((values[order], table["sketched"].to_numpy(bool)[order]))
        found = plain.mapInArrow(_document_rows(width, sent), f"_row {kind}, shingle bigint")
    else:
        every = plain.mapInArrow(_all_document_rows(width), f"_row {kind}, shingle bigint")
        found = every.join(index.select("shingle").distinct(), "shingle", "left_semi")
    pairs = found.distinct().join(index, "shingle")
    shared = pairs.groupBy("_row", "item_id").agg(F.count("*").alias("shared"), F.bool_or("sketched").alias("met")).where("met")
    verified = shared.join(sizes.withColumnRenamed("item_id", "_item"), F.expr("item_id <=> _item"))
    return verified.where(F.col("shared") * 100 >= F.col("item_size") * percent).select("_row.doc_id", "_row.mark", "item_id", "shared", "item_size")


def drop_leaking(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, whole, into which no item leaks."""
    found = materialise(leaks(docs, items, id_col, text_col, **options).select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).distinct(), "leaks")
    return docs.join(found, docs[id_col].eqNullSafe(found["_id"]) & (F.xxhash64(docs[text_col]) == found["_mark"]), "left_anti")
