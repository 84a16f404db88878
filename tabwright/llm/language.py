"""Languages of a text as a mixture: expectation-maximisation over words, the language set chosen by penalised likelihood.

A word's likelihood in a language is the product of its letters' trigrams, each letter with its two neighbours, and a
text's words come from its languages in unknown proportions. For 1, 2, 3, ... languages the best set is grown by one,
its proportions are found by expectation-maximisation, and growth stops where the likelihood gains less than the penalty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm import words
from tabwright.llm.shipping import ship

BUCKETS = 1 << 16
ROWS_AT_ONCE = 2_000
UNKNOWN = "und"


@dataclass
class Profiles:
    """Learned languages in order, and the log likelihood of every trigram bucket in each."""

    languages: list[str]
    table: np.ndarray


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _trigrams(distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every letter of the distinct words, and the word it is of. What is no letter counts as a word's edge."""
    lowered = pc.utf8_lower(distinct).to_pylist()
    code = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le"), np.uint32)
    ends = np.cumsum(code == 10)
    letter = _letters()[code]
    edged = np.where(letter, code, 0).astype(np.uint64)
    at = np.flatnonzero(letter)
    spread = words.mix(edged[at - 1] << np.uint64(42) ^ edged[at] << np.uint64(21) ^ edged[at + 1])
    return (spread >> np.uint64(48)).astype(np.int64), ends[at] - 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: how often each bucket occurs in each language, summed over the task's texts."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            part = batch.slice(at, ROWS_AT_ONCE)
            bounds, distinct, index = words.words_of(words.as_text(part.column("text")))
            if not len(distinct):
                continue
            bucket, word = _trigrams(distinct)
            named = part.column("lang").to_pylist()
            of_word = np.repeat(np.arange(len(named)), np.diff(bounds))
            for lang in set(named):
                own = np.fromiter((x == lang for x in named), bool, len(named))[of_word]
                times = np.bincount(index[own], minlength=len(distinct))
                total[lang] = total.get(lang, 0) + np.bincount(bucket, times[word], BUCKETS).astype(np.int64)
    for lang, counts in total.items():
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(held), pa.string()), pa.array(held), pa.array(counts[held])], ["lang", "bucket", "n"])


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", smoothing: float = 0.5) -> Profiles:
    """Profiles from every row that has a text and a language.

    Each task sums its own counts, so at most ``BUCKETS`` numbers per language leave a task or reach the driver.
    """
    ship(docs.sparkSession)
    known = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    rows = known.mapInArrow(_counted, "lang string, bucket bigint, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(rows["lang"].unique())
    counts = np.zeros((BUCKETS, len(languages)))
    counts[rows["bucket"].to_numpy(), rows["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy(dtype=int)] = rows["n"]
    smooth = counts + smoothing
    return Profiles(languages, np.log(smooth / smooth.sum(axis=0, keepdims=True)).astype(np.float32))


def mixtures(likely: np.ndarray, bounds: np.ndarray, penalty: float, rounds: int = 8) -> np.ndarray:
    """Language proportions of every text, from the log likelihoods of its words (words by languages).

    A further language must raise the log likelihood by ``penalty`` times the log of the number of words.
    """
    count, width = np.diff(bounds), likely.shape[1]
    shares = np.zeros((len(count), width))
    texts = np.flatnonzero(count)
    if not len(texts):
        return shares
    single = np.add.reduceat(likely, bounds[:-1][texts], axis=0)
    first = single.argmax(axis=1)
    shares[texts, first] = 1
    best = single[np.arange(len(texts)), first].astype(float)
    top = likely.max(axis=1, keepdims=True)
    even = np.exp(likely - top).astype(float)
    floor = np.add.reduceat(top[:, 0].astype(float), bounds[:-1][texts])
    for _ in range(width - 1):
        n = count[texts]
        at = np.concatenate([np.arange(bounds[t], bounds[t + 1]) for t in texts])
        starts, of = np.concatenate([[0], np.cumsum(n)[:-1]]), np.repeat(np.arange(len(texts)), n)
        words_even, now = even[at], shares[texts]
        # The language that the words so far explained worst call for most.
        explained = (words_even * now[of]).sum(axis=1)
        call = np.add.reduceat(words_even / np.maximum(explained, 1e-300)[:, None], starts, axis=0)
        call[now > 0] = -1
        new = call.argmax(axis=1)
        trial = now * 0.8
        trial[np.arange(len(texts)), new] = 0.2
        for _ in range(rounds):
            mixed = words_even * trial[of]
            whole = np.maximum(mixed.sum(axis=1), 1e-300)
            trial = np.add.reduceat(mixed / whole[:, None], starts, axis=0) / n[:, None]
        value = np.add.reduceat(np.log(np.maximum((words_even * trial[of]).sum(axis=1), 1e-300)), starts) + floor
        better = value - best > penalty * np.log(n + 1)
        shares[texts[better]] = trial[better]
        texts, best, floor = texts[better], value[better], floor[better]
        if not len(texts):
            break
    return shares


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text", penalty: float = 3.0) -> DataFrame:
    """``(doc_id, lang_pred, score, mixture)`` for every row: the main language, its share, and all languages' shares.

    Only the text counts. A null text, one without letters, or profiles without languages give ``und``, score 0 and an
    empty mixture. Equal shares go to the language that sorts first. Null ids pass through; repeated rows come out
    repeated; other columns are not read; an empty table gives no rows.
    """
    ship(docs.sparkSession)
    plain = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(profiles)  # BUCKETS numbers per language
    share = pa.struct([("lang", pa.string()), ("share", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        names = known.languages
        for batch in batches:
            for low in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(low, ROWS_AT_ONCE)
                shares = np.zeros((part.num_rows, max(1, len(names))))
                bounds, distinct, index = words.words_of(words.as_text(part.column("text")))
                if names and len(distinct):
                    bucket, word = _trigrams(distinct)
                    table = np.zeros((len(distinct), len(names)), np.float32)
                    held, first = np.unique(word, return_index=True)
                    if len(held):
                        table[held] = np.add.reduceat(known.table[bucket], first, axis=0)
                    spoken = np.zeros(len(distinct), bool)
                    spoken[held] = True
                    said = spoken[index]
                    kept = np.concatenate([[0], np.cumsum(said)])[bounds]
                    shares = mixtures(table[index[said]], kept, penalty)
                main = shares.argmax(axis=1)
                score = shares[np.arange(len(main)), main]
                predicted = [names[m] if s > 0 else UNKNOWN for m, s in zip(main.tolist(), score.tolist(), strict=True)]
                mixed = [[{"lang": names[k], "share": float(row[k])} for k in np.flatnonzero(row > 0)] for row in shares]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(predicted, pa.string()), pa.array(np.minimum(score, 1.0)), pa.array(mixed, pa.list_(share))], ["doc_id", "lang_pred", "score", "mixture"])

    mixture = T.ArrayType(T.StructType([T.StructField("lang", T.StringType()), T.StructField("share", T.DoubleType())]))
    fields = [plain.schema["doc_id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("mixture", mixture)]
    return plain.mapInArrow(run, T.StructType(fields))
