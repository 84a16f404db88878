"""Document quality by a sparse rule ensemble.

Statistics of a text are taken in one pass. Trees of a small forest are grown on labelled statistics; every path from a
root becomes a rule, a conjunction of comparisons; a lasso logistic regression weighs the rules and drops most of them;
the rest are compiled into one Spark column expression over the statistics.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm import words
from tabwright.llm.shipping import ship
from tabwright.session import materialise

ROWS_AT_ONCE = 2_000
# Byte classes whose shares of a text are statistics; bytes beyond ASCII are the class "wide".
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "blank": b" \t",
    "line": b"\n\r",
    "stop": b".,;:",
    "cry": b"!?",
    "bar": b"|",
    "mark": b"#$%&*+/<=>@\\^_`{}~",
    "quote": b"\"'()[]-",
}
STATISTICS = (*(f"{c}_share" for c in CLASSES), "wide_share", "log_words", "word_length", "distinct_words", "distinct_lines", "longest_word")


def _measured(texts: pa.Array) -> np.ndarray:
    """A row of statistics for every text; all zero for a text without bytes."""
    data = np.frombuffer(texts.buffers()[2], np.uint8) if len(texts) and texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = data[offsets[0] : offsets[-1]]
    bounds = offsets - offsets[0]
    size = np.maximum(np.diff(bounds), 1)
    out = np.zeros((len(texts), len(STATISTICS)))
    full = np.diff(bounds) > 0
    which = np.full(256, len(CLASSES), np.uint8)
    which[:128] = 255
    for k, members in enumerate(CLASSES.values()):
        which[np.frombuffer(members, np.uint8)] = k
    kind = which[data]
    for k in range(len(CLASSES) + 1):
        if full.any():
            out[full, k] = np.add.reduceat((kind == k).astype(np.int32), bounds[:-1][full]) / size[full]
    at, distinct, index = words.words_of(texts)
    n = np.diff(at)
    some = n > 0
    if some.any():
        lengths = pc.utf8_length(distinct).to_numpy(zero_copy_only=False)[index]
        out[:, -5] = np.log1p(n)
        out[some, -4] = np.add.reduceat(lengths, at[:-1][some]) / n[some]
        out[some, -3] = [len(np.unique(index[a:b])) / (b - a) for a, b in zip(at[:-1][some].tolist(), at[1:][some].tolist(), strict=True)]
        out[some, -1] = np.log1p(np.maximum.reduceat(lengths, at[:-1][some]))
    lines = [t.split("\n") for t in texts.to_pylist()]
    out[:, -2] = [len(set(x)) / len(x) for x in lines]
    return out


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the statistics of every row's whole text; a null text counts as empty."""
    ship(docs.sparkSession)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                found = _measured(words.as_text(part.column("text")))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(found[:, k]) for k in range(found.shape[1]))], ["doc_id", *STATISTICS])

    return plain.mapInArrow(run, T.StructType([plain.schema["doc_id"], *(T.StructField(s, T.DoubleType()) for s in STATISTICS)]))


@dataclass(frozen=True)
class Rule:
    """Comparisons ``(statistic, above, threshold)`` that must all hold, and the rule's weight."""

    terms: tuple[tuple[str, bool, float], ...]
    weight: float = 0.0

    def column(self) -> Column:
        return reduce(Column.__and__, (F.col(s) > t if above else F.col(s) <= t for s, above, t in self.terms))


@dataclass(frozen=True)
class Ensemble:
    """Weighted rules and an intercept."""

    rules: tuple[Rule, ...]
    intercept: float

    def column(self) -> Column:
        """The chance of a good text as one expression over the statistics."""
        total = F.lit(self.intercept)
        for r in self.rules:
            total = total + F.when(r.column(), F.lit(r.weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def tree_rules(description: str) -> set[Rule]:
    """All paths from the root, inner ones too, of a tree as ``toDebugString`` prints it."""
    rules: set[Rule] = set()
    path: list[tuple[str, bool, float]] = []
    for line in description.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if found:
            depth, feature, sign, limit = found.groups()
            level = len(depth)
            path = [p for p in path if p[3] < level] + [(STATISTICS[int(feature)], sign == ">", float(limit), level)]
            rules.add(Rule(tuple(sorted({p[:3] for p in path}))))
    return rules


def fit(measured: DataFrame, labels: DataFrame, *, label_col: str = "quality", id_col: str = "doc_id", trees: int = 16, depth: int = 3, penalty: float = 0.001, seed: int = 11) -> Ensemble:
    """Rules from all labelled rows of ``measured``, the result of ``statistics``.

    Rows without a label or an id take no part. Without both labels the share of good ones is the score of every text.
    """
    known = labels.select(F.col(id_col).alias("_id"), (F.col(label_col) == 1).cast("double").alias("label")).dropna()
    rows = materialise(measured.join(known, measured["doc_id"] == known["_id"]).select(*STATISTICS, "label"), "labelled")
    total, good = rows.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    share = (good + 0.5) / (total + 1)
    constant = Ensemble((), float(np.log(share / (1 - share))))
    if not 0 < good < total:
        return constant
    table = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(rows)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="onethird").fit(table)
    rules = sorted(set().union(*(tree_rules(t.toDebugString) for t in forest.trees)), key=lambda r: r.terms)
    if not rules:
        return constant
    holds = F.array(*(r.column().cast("double") for r in rules))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=60).fit(rows.select(array_to_vector(holds).alias("features"), "label"))
    weighed = zip(rules, lasso.coefficients.toArray().tolist(), strict=True)
    return Ensemble(tuple(Rule(r.terms, w) for r, w in weighed if w), float(lasso.intercept))


def score(measured: DataFrame, ensemble: Ensemble) -> DataFrame:
    """``(doc_id, score)`` for every measured row.

    Empty texts have zero statistics and are scored like any other. Null ids pass through; repeated rows come out
    repeated; an empty table gives no rows.
    """
    return measured.select("doc_id", ensemble.column().alias("score"))
