"""Toxic spans and document scores by a linear-chain conditional random field with two states.

Document labels become token labels: features (a word or its first letters) that speak for toxic documents are chosen
greedily, each for toxic documents that earlier ones leave unexplained, so that words which merely occur in copies of a
toxic document are not. In toxic documents the tokens with a chosen feature are the labelled ones. The field learns from
every window of 32 words that holds a chosen feature, in toxic and in clean documents; the words of all other windows
count as clean tokens, each with the number of times it occurs. Forward-backward marginals give the offending offsets,
and a logistic curve over their sum, maximum and number gives the document's score.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm import words
from tabwright.llm.shipping import ship
from tabwright.session import materialise

PREFIXES = (4, 5, 6)
WINDOW = 32  # words
ROWS_AT_ONCE = 2_000
_RUN = re.compile("[^\x20\x09-\x0d]+")
_EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")


def features(word: str) -> tuple[str, ...]:
    """A token's features: the word without outer marks, and its first letters. A token without letters has none."""
    core = (word if word.isalpha() else _EDGE.sub("", word)).lower()
    if not core:
        return ()
    return (f"={core}", *(core[:n] for n in PREFIXES if len(core) >= n))


@dataclass
class Field:
    """A fitted model: feature weights, the toxic state's bias and transitions, and the document curve."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -8.0
    transitions: tuple[tuple[float, float], tuple[float, float]] = ((0.0, 0.0), (0.0, 0.0))
    curve: tuple[float, ...] = (-4.0, 0.0, 0.0, 0.0)

    def emission(self, word: str) -> float:
        return self.bias + sum(self.weights.get(f, 0.0) for f in features(word))


def marginals(scores: np.ndarray, bounds: np.ndarray, transitions: tuple) -> np.ndarray:
    """Chance of the toxic state at every token, by forward and backward odds over all texts at once.

    ``scores`` are log odds of the emissions; texts go from long to short, so that at step t the running ones come first.
    """
    (a00, a01), (a10, a11) = np.exp(np.asarray(transitions))
    odds = np.exp(np.clip(scores, -40, 40))
    sizes = np.diff(bounds)
    order = np.argsort(-sizes, kind="stable")
    start, sizes = bounds[:-1][order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    alive = np.searchsorted(-sizes, -np.arange(longest), side="left")
    forward, backward = np.empty(len(odds)), np.ones(len(odds))
    r = None
    for t in range(longest):
        at = start[: alive[t]] + t
        e = odds[at]
        r = e if r is None else e * (a01 + r[: alive[t]] * a11) / (a00 + r[: alive[t]] * a10)
        forward[at] = r
    for t in range(longest - 2, -1, -1):
        at = start[: alive[t + 1]] + t
        s = odds[at + 1] * backward[at + 1]
        backward[at] = (a10 + a11 * s) / (a00 + a01 * s)
    both = forward * backward
    return both / (1 + both)


def _summary(chance: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per text: a constant, the log of the expected toxic tokens, the largest chance, and the log of the likely ones."""
    out = np.zeros((len(bounds) - 1, 4))
    out[:, 0] = 1
    full = np.diff(bounds) > 0
    if full.any():
        first = bounds[:-1][full]
        out[full, 1] = np.log1p(np.add.reduceat(chance, first))
        out[full, 2] = np.maximum.reduceat(chance, first)
        out[full, 3] = np.log1p(np.add.reduceat((chance > 0.5).astype(float), first))
    return out


def _telling(docs: list[list[str]], toxic: np.ndarray, least: int, precision: float) -> set[str]:
    """Features that explain the toxic documents, given the words of each: chosen greedily by the documents that still
    lack two of them."""
    known: dict[str, tuple[str, ...]] = {}

    def held(d: list[str], among: set[str] | None = None) -> set[str]:
        found = {f for w in d for f in (known.get(w) or known.setdefault(w, features(w)))}
        return found if among is None else found & among

    places = np.flatnonzero(toxic).tolist()
    good, bad = Counter(), Counter()
    for i in places:
        good.update(held(docs[i]))
    frequent = {f for f, n in good.items() if n >= least}
    for i in np.flatnonzero(~toxic).tolist():
        bad.update(held(docs[i], frequent))
    weight = (~toxic).sum() / max(1, toxic.sum())
    likely = {f for f in frequent if good[f] * weight >= precision * (good[f] * weight + bad[f])}
    has = {i: held(docs[i], likely) for i in places}
    where: dict[str, list[int]] = {f: [] for f in likely}
    for i in places:
        for f in has[i]:
            where[f].append(i)
    need = dict.fromkeys(places, 2)
    gain, chosen = {f: len(x) for f, x in where.items()}, set()
    while gain:
        best = max(gain, key=lambda f: (gain[f] - weight * bad[f], -len(f), f))
        if gain[best] < max(2, least // 2):  # what copies share has no gain once their telling words are found
            break
        chosen.add(best)
        del gain[best]
        for i in where[best]:
            need[i] -= 1
            if need[i] == 0:
                for f in has[i] & gain.keys():
                    gain[f] -= 1
    return chosen


@dataclass
class Tagged:
    """What the field learns from: windows with a tag for each word, and how often every other word occurs."""

    windows: list[list[str]] = field(default_factory=list)
    tags: list[list[int]] = field(default_factory=list)
    rest: Counter = field(default_factory=Counter)

    def add(self, text: str | None, toxic: bool, telling: set[str]) -> None:
        """All windows of a text that hold a telling feature, tagged if the text is toxic; the other words are counted."""
        found = _RUN.findall(text or "")
        hits = {w: not telling.isdisjoint(features(w)) for w in set(found)}
        for k in range(0, len(found), WINDOW):
            part = found[k : k + WINDOW]
            marks = [hits[w] for w in part]
            if any(marks):
                self.windows.append(part)
                self.tags.append([int(m and toxic) for m in marks])
            else:
                self.rest.update(part)


def _fit_field(seen: Tagged, steps: int) -> Field:
    """Maximise the penalised likelihood of the tags by Adam over all windows and all other words."""
    rest = sorted(seen.rest)
    names: dict[str, int] = {}
    token = np.array([names.setdefault(w, len(names)) for t in [*seen.windows, rest] for w in t], np.int64)
    inside = sum(map(len, seen.windows))
    within = {w for t in seen.windows for w in t}
    vocabulary: dict[str, int] = {}
    slots = np.full((len(names), 1 + len(PREFIXES)), -1, np.int32)
    for w, i in names.items():
        for k, f in enumerate(features(w)):  # what no window holds is told by the bias alone
            slots[i, k] = vocabulary.setdefault(f, len(vocabulary)) if w in within else vocabulary.get(f, -1)
    ids = slots[token]
    bounds = np.concatenate([np.cumsum([0, *map(len, seen.windows)]), inside + 1 + np.arange(len(rest))])
    y = np.array([t for tags in seen.tags for t in tags] + [0] * len(rest), float)
    times = np.concatenate([np.ones(inside), [seen.rest[w] for w in rest]])
    inner = np.ones(len(token), bool)
    inner[bounds[:-1]] = False
    after = np.flatnonzero(inner)
    size = len(vocabulary) + 1
    theta, m, v = np.zeros(size + 4), np.zeros(size + 4), np.zeros(size + 4)
    theta[size - 1] = -3.0
    held = np.bincount((2 * y[after - 1] + y[after]).astype(int), minlength=4)
    flat = ids.ravel()
    for step in range(1, steps + 1):
        table = np.append(theta[: size - 1], 0.0)
        scores = table[ids].sum(axis=1) + theta[size - 1]
        moves = theta[size:].reshape(2, 2)
        p = marginals(scores, bounds, moves)
        pair = _pair_sums(scores, p, after, moves)
        grad = np.zeros(size + 4)
        error = (p - y) * times
        grad[: size - 1] = np.bincount(flat[flat >= 0], np.repeat(error, ids.shape[1])[flat >= 0], minlength=size - 1)
        grad[size - 1] = error.sum()
        grad[size:] = pair - held
        grad += 0.3 * np.append(theta[: size - 1], np.zeros(5))
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta -= 0.2 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    weights = {f: round(float(theta[i]), 4) for f, i in vocabulary.items() if abs(theta[i]) >= 0.05}
    moves = tuple(tuple(map(float, r)) for r in theta[size:].reshape(2, 2))
    return Field(weights, float(theta[size - 1]), moves)


def _pair_sums(scores: np.ndarray, p: np.ndarray, after: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Expected number of each of the four transitions, from neighbouring marginals.

    The chance of a pair has their two marginals as margins and the transition's odds ratio, which fix it exactly.
    """
    a, b = p[after - 1], p[after]
    ratio = np.exp(moves[0, 0] + moves[1, 1] - moves[0, 1] - moves[1, 0])
    if abs(ratio - 1) < 1e-9:
        both = a * b
    else:
        s = 1 + (a + b) * (ratio - 1)
        both = 2 * ratio * a * b / (s + np.sqrt(np.maximum(0.0, s * s - 4 * ratio * (ratio - 1) * a * b)))
    return np.array([(1 - a - b + both).sum(), (b - both).sum(), (a - both).sum(), both.sum()])


def _fit_curve(x: np.ndarray, toxic: np.ndarray, times: np.ndarray) -> tuple[float, ...]:
    """Logistic curve by Newton steps; a document weighs ``times``, so that both labels weigh as they occur."""
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-3] + [0.05] * (x.shape[1] - 1))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        step = np.linalg.solve((x * (times * p * (1 - p))[:, None]).T @ x + ridge, x.T @ (times * (p - toxic)) + ridge @ w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(map(float, w))


def _flat(toxic: float, all_: float) -> Field:
    share = (toxic + 0.5) / (all_ + 1)
    return Field(curve=(float(np.log(share / (1 - share))), 0.0, 0.0, 0.0))


def _least(least: int, toxic: int) -> int:
    return max(least, int(0.002 * toxic))


def fit(texts: list[str], toxic: list[int], *, least: int = 4, precision: float = 0.9, steps: int = 80) -> Field:
    """Fit on labelled texts. Without both labels, or without any telling feature, the share of toxic texts is the score."""
    y = np.asarray(toxic, dtype=int) == 1
    if y.all() or not y.any():
        return _flat(y.sum(), len(y))
    telling = _telling([sorted(set(_RUN.findall(t or ""))) for t in texts], y, _least(least, y.sum()), precision)
    seen = Tagged()
    for t, label in zip(texts, y.tolist(), strict=True):
        seen.add(t, label, telling)
    if not any(map(any, seen.tags)):
        return _flat(y.sum(), len(y))
    model = _fit_field(seen, steps)
    model.curve = _fit_curve(np.concatenate([_evidence(pa.array([t], pa.string()), model)[0] for t in texts]), y.astype(float), np.ones(len(y)))
    return model


def _words_of_sample(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(set(_RUN.findall(t))) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("toxic"), pa.array(found, pa.list_(pa.string()))], ["digest", "toxic", "words"])


def _tagged_sample(telling: set[str]):
    """Task: the windows of its texts, and its other words with their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["digest", "place", "words", "tags", "word", "times"]
        kinds = [pa.string(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.string(), pa.int64()]
        rest: Counter = Counter()
        for batch in batches:
            rows = []
            for digest, toxic, text in zip(*(batch.column(c).to_pylist() for c in ("digest", "toxic", "text")), strict=True):
                seen = Tagged()
                seen.add(text, toxic, telling)
                rows += [(digest, k, w, t, None, None) for k, (w, t) in enumerate(zip(seen.windows, seen.tags, strict=True))]
                rest.update(seen.rest)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[k]) for k in range(6)], names)
        counted = sorted(rest.items())
        yield pa.RecordBatch.from_arrays([*(pa.nulls(len(counted), kinds[k]) for k in range(4)), pa.array([w for w, _ in counted], kinds[4]), pa.array([n for _, n in counted], kinds[5])], names)

    return run


def _summaries_of_sample(model: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _evidence(batch.column("text"), model)[0]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("toxic"), pa.array(x.tolist(), pa.list_(pa.float64()))], ["digest", "toxic", "x"])

    return run


def fit_from_labels(
    docs: DataFrame, labels: DataFrame, *, per_label: int = 1_500, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
    least: int = 4, precision: float = 0.9, steps: int = 80,
) -> Field:
    """Fit on at most ``per_label`` labelled texts of each label, chosen by a digest of the text.

    That bound is the only one: of the chosen texts every window and word takes part. Equal texts count once, and as
    toxic if any label says so. Rows without an id, a text or a label take no part. The curve weighs each label by the
    number of its texts among all that are labelled, so a score does not depend on how many were chosen. Texts stay in
    their tasks: the driver gets the different words of each chosen text, the windows that hold a telling word, and the
    numbers of the other words. ``docs`` and ``labels`` are whatever the caller allows to learn from.
    """
    ship(docs.sparkSession)
    known = labels.select(F.col(id_col).alias("_id"), (F.col(label_col) == 1).alias("toxic")).dropna()
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text")).dropna()
    own = texts.select("_id", F.md5("text").alias("digest")).join(known, "_id")
    labelled = materialise(own.groupBy("digest").agg(F.max("toxic").alias("toxic"), F.min("_id").alias("_id")), "labelled")
    sizes = {r["toxic"]: r["count"] for r in labelled.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return _flat(sizes.get(True, 0), sum(sizes.values()))
    picks = [labelled.where(c).orderBy(F.xxhash64("digest"), "digest").limit(per_label) for c in (F.col("toxic"), ~F.col("toxic"))]
    chosen = F.broadcast(picks[0].union(picks[1]))  # at most 2 * per_label short rows
    sample = texts.join(chosen, "_id").where(F.md5("text") == F.col("digest")).select("digest", "toxic", "text").dropDuplicates(["digest"])
    sample = materialise(sample, "labelled-sample")
    held = sample.mapInArrow(_words_of_sample, "digest string, toxic boolean, words array<string>").orderBy("digest").toArrow()
    y = held.column("toxic").to_numpy().astype(bool)
    telling = _telling(held.column("words").to_pylist(), y, _least(least, y.sum()), precision)
    tagged = sample.mapInArrow(_tagged_sample(telling), "digest string, place int, words array<string>, tags array<int>, word string, times long")
    tagged = materialise(tagged, "tagged")
    windows = tagged.where("words is not null").select("digest", "place", "words", "tags").orderBy("digest", "place").toArrow()
    rest = tagged.where("word is not null").groupBy("word").agg(F.sum("times").alias("times")).toArrow()
    seen = Tagged(windows.column("words").to_pylist(), windows.column("tags").to_pylist(), Counter(dict(zip(rest.column("word").to_pylist(), rest.column("times").to_pylist(), strict=True))))
    if not any(map(any, seen.tags)):
        return _flat(sizes[True], sum(sizes.values()))
    model = _fit_field(seen, steps)
    shown = sample.mapInArrow(_summaries_of_sample(model), "digest string, toxic boolean, x array<double>").orderBy("digest").toArrow()
    x, y = np.array(shown.column("x").to_pylist()).reshape(-1, 4), shown.column("toxic").to_numpy().astype(bool)
    weight = np.where(y, sizes[True] / max(1, y.sum()), sizes[False] / max(1, (~y).sum()))
    model.curve = _fit_curve(x, y.astype(float), weight * len(y) / weight.sum())
    return model


def _evidence(texts: pa.Array, model: Field) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's summary, the chance of every token, and each text's bounds among them."""
    bounds, distinct, index = words.words_of(words.as_text(texts))
    table = np.fromiter(map(model.emission, distinct.to_pylist()), float, len(distinct))
    chance = marginals(table[index] if len(index) else np.zeros(0), bounds, model.transitions)
    return _summary(chance, bounds), chance, bounds


def score(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text", confident: float = 0.5) -> DataFrame:
    """``(doc_id, score, spans)`` for every row: the document's score, and where toxic runs start and end.

    ``spans`` holds ``(start, end, chance)`` of runs of tokens whose chance is over ``confident``, in code points, end
    exclusive. A null, empty or blank text has no spans and the curve's lowest score. Ids, nulls among them, pass
    through; repeated rows come out repeated; other columns are not read; an empty table gives no rows.
    """
    return _scored(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), model, confident)


def drop_toxic(docs: DataFrame, model: Field, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs``, whole, whose text scores under ``threshold``. Rows never leave their task.

    A null, empty or blank text has the curve's lowest score. Repeated rows, rows without an id and all columns, whatever
    their names, stay as they are; an empty table gives no rows.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(text_col).alias("text"))
    return _scored(rows, model, 2.0).where(F.col("score") < threshold).select("row.*")


def _scored(plain: DataFrame, model: Field, confident: float) -> DataFrame:
    """The first column of ``plain``, passed through, with score and spans of its second."""
    ship(plain.sparkSession)
    sent = plain.sparkSession.sparkContext.broadcast(model)  # bounded by the fitting sample's vocabulary
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("chance", pa.float64())])
    name = plain.columns[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field_ = sent.value
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(at, ROWS_AT_ONCE)
                x, chance, bounds = _evidence(part.column("text"), field_)
                scores = 1 / (1 + np.exp(-np.clip(x @ np.array(field_.curve), -40, 40)))
                spans = [_spans(part.column("text")[i].as_py(), chance[a:b], confident) if x[i, 2] > confident else [] for i, (a, b) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(scores), pa.array(spans, pa.list_(span))], [name, "score", "spans"])

    kinds = [plain.schema[0], T.StructField("score", T.DoubleType())]
    spans = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("chance", T.DoubleType())]))
    return plain.mapInArrow(run, T.StructType([*kinds, T.StructField("spans", spans)]))


def _spans(text: str, chance: np.ndarray, confident: float) -> list[dict]:
    out = []
    last = -2
    for i, run in enumerate(_RUN.finditer(text)):
        if chance[i] > confident:
            if last == i - 1:
                out[-1]["end"] = run.end()
                out[-1]["chance"] = max(out[-1]["chance"], float(chance[i]))
            else:
                out.append({"start": run.start(), "end": run.end(), "chance": float(chance[i])})
            last = i
    return out
