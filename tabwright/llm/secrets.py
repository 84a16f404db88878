"""Secret scans through a trigram inverted index, in DataFrame functions only.

Each rule's regular expression yields a Boolean query over trigrams that any match must hold. One pass over the texts
writes the postings of exactly those trigrams. Intersecting the postings of a rule's query gives its candidate
documents, and only these are read again and verified with the expression. A rule without mandatory trigrams scans all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwright.llm.trigrams import Query, query_of
from tabwright.session import materialise

BITS = 62
_SAME = "doc_id <=> _id and mark = _mark"
_SPANS = "array<struct<start:bigint,kind_rank:int,kind:string,end:bigint>>"


@dataclass(frozen=True)
class Rule:
    """Leftmost matches of ``pattern``, that do not overlap, and whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# Fixed values. A run of 24 or more is what a run of any length, kept from 24 on, comes to; likewise for access keys.
BASE_RULES = (
    Rule("assign", "(?i:(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?)([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("private_key", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("web_token", "eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}"),
    Rule("service_token", "(?:ghp|gho|ghs|xoxb|xoxp)[_-][A-Za-z0-9-]{20,}"),
)


def _meets(query: Query, vocabulary: list[str]) -> Column:
    def has(t: str) -> Column:
        k = vocabulary.index(t)
        return F.col(f"mask{k // BITS}").bitwiseAND(F.lit(1 << k % BITS)) != 0

    return reduce(Column.__or__, (reduce(Column.__and__, map(has, sorted(a))) for a in query.alternatives))


def _postings(rows: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``(trigram, doc_id, mark)`` of the vocabulary's trigrams in every text."""
    low = F.lower("text")
    held = F.array_compact(F.array(*(F.when(F.contains(low, F.lit(t)), F.lit(k)) for k, t in enumerate(vocabulary))))
    return rows.select(F.explode(held).alias("trigram"), "doc_id", "mark")


def _matches(rows: DataFrame, rule: Rule) -> DataFrame:
    """``(doc_id, mark, kind, start, end)``: a match starts where the texts between matches, and the matches, end."""
    text, pattern = F.col("text"), F.lit(rule.pattern)
    lengths = [F.transform(x, F.length) for x in (F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0)), F.regexp_extract_all(text, pattern, F.lit(rule.group)))]
    found = rows.where(text.rlike(rule.pattern)).select("doc_id", "mark", F.arrays_zip(*(x.alias(n) for x, n in zip(lengths, ("gap", "whole", "kept"), strict=True))).alias("z"))
    # A text's matches are few next to the text: running totals stay inside the row.
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint,kept:bigint>>").alias("spans"))

    def add(state: Column, m: Column) -> Column:
        start = state["at"] + m["gap"]
        end = start + F.coalesce(m["whole"], F.lit(0))
        span = F.struct(start.alias("start"), end.alias("end"), m["kept"].cast("bigint").alias("kept"))
        return F.struct(end.alias("at"), F.when(m["kept"] >= rule.least, F.array_append(state["spans"], span)).otherwise(state["spans"]).alias("spans"))

    spans = F.explode(F.aggregate("z", zero, add, lambda s: s["spans"])).alias("span")
    return found.select("doc_id", "mark", spans).select("doc_id", "mark", F.lit(rule.kind).alias("kind"), "span.start", "span.end")


def find_secrets(docs: DataFrame, rules: Sequence[Rule] = BASE_RULES + MORE_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, spans)`` for every row: its secrets as ``(start, kind_rank, kind, end)``, by start, then the rules' order.

    Offsets are code points, ends exclusive. Matches of one rule do not overlap; different rules may. A null or empty
    text has no spans. Null ids pass through; rows that share an id are told apart by their texts; repeated rows come out
    repeated; other columns are not read; an empty table gives no rows.
    """
    rows = _rows(docs, id_col, text_col)
    joined = rows.select("doc_id", "mark").join(_found(rows, rules), F.expr(_SAME), "left")
    return joined.select("doc_id", F.coalesce("spans", F.array().cast(_SPANS)).alias("spans"))


def redact(docs: DataFrame, rules: Sequence[Rule] = BASE_RULES + MORE_RULES, id_col: str = "doc_id", text_col: str = "text", cover: str = "[secret]") -> DataFrame:
    """``docs``, whole, with every run of text that spans cover replaced by ``cover``; other rows are as they were.

    Null and empty texts stay; rows that share an id are covered by their own text's spans; repeated rows, rows without an
    id and all columns, whatever their names, stay; an empty table gives no rows.
    """
    found = _found(_rows(docs, id_col, text_col), rules)
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    text = F.col("row")[text_col]
    joined = rows.join(found, F.col("row")[id_col].eqNullSafe(found["_id"]) & (F.xxhash64(F.coalesce(text, F.lit(""))) == found["_mark"]), "left")
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))

    def add(state: Column, s: Column) -> Column:
        # Spans come by start: one that begins inside the last only moves its end.
        between = F.substr(text, (state["at"] + 1).cast("int"), F.greatest(s["start"] - state["at"], F.lit(0)).cast("int"))
        new = s["start"] >= state["at"]
        return F.struct(F.when(new, F.concat(state["out"], between, F.lit(cover))).otherwise(state["out"]).alias("out"), F.greatest(s["end"], state["at"]).alias("at"))

    clean = F.aggregate("spans", start, add, lambda s: F.concat(s["out"], F.substr(text, (s["at"] + 1).cast("int"))))
    columns = [F.col("row")[c] if c != text_col else F.when(F.col("spans").isNull(), text).otherwise(clean) for c in docs.columns]
    return joined.select(*(x.alias(c) for x, c in zip(columns, docs.columns, strict=True)))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.select("doc_id", "text", F.xxhash64("text").alias("mark"))


def _found(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``(_id, _mark, spans)`` of the rows that hold secrets."""
    queries = {r.kind: query_of(r.pattern) for r in rules}
    vocabulary = sorted(set().union(*(q.trigrams() for q in queries.values())))
    hits = [_matches(rows, r) for r in rules if queries[r.kind].scans_all]
    if vocabulary:
        postings = materialise(_postings(rows, vocabulary), "postings")
        masks = [
            F.expr(f"bit_or(CASE WHEN trigram DIV {BITS} = {m} THEN shiftleft(1L, trigram % {BITS}) ELSE 0L END)").alias(f"mask{m}")
            for m in range(-(-len(vocabulary) // BITS))
        ]
        held = postings.groupBy("doc_id", "mark").agg(*masks)
        asked = [r for r in rules if not queries[r.kind].scans_all]
        found = F.array_compact(F.array(*(F.when(_meets(queries[r.kind], vocabulary), F.lit(r.kind)) for r in asked)))
        candidates = materialise(held.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"), found.alias("rules")).where("size(rules) > 0"), "candidates")
        checked = rows.join(candidates, F.expr(_SAME)).select("doc_id", "mark", "text", "rules")
        hits += [_matches(checked.where(F.array_contains("rules", r.kind)), r) for r in asked]
    rank = F.element_at(F.create_map(*(F.lit(x) for k, r in enumerate(rules) for x in (r.kind, k))), F.col("kind"))
    every = reduce(DataFrame.union, hits).distinct()
    spans = F.sort_array(F.collect_list(F.struct("start", rank.alias("kind_rank"), "kind", "end"))).alias("spans")
    return every.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark")).agg(spans)


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
