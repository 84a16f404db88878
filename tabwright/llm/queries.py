"""The registered queries of this package: thin calls of the operators on whole tables, and their SQL where there is any."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.llm import bpe, decontaminate, html_text, language, near_dup, periodic_runs, quality, secrets, suffix_dedup, token_counts, top_k, toxicity, whitening
from tabwright.session import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLES[name] = sql
        return function

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shingle_sql(width: int, table: str = "documents", key: str = "doc_id") -> str:
    """CTEs ``words`` and ``shingles(key, s)``: distinct runs of ``width`` lower-cased words, or the whole of a shorter text."""
    run = " || ' ' || ".join(f"w[i + {k}]" for k in range(width))
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""words AS (SELECT {key}, regexp_extract_all({lower}, '[^\\x20\\x09-\\x0D]+') AS w FROM {table}),
      shingles AS (SELECT DISTINCT {key}, s FROM (
        SELECT {key}, {run} AS s FROM (SELECT {key}, w, unnest(range(1, len(w) - {width - 2})) AS i FROM words WHERE len(w) >= {width})
        UNION ALL SELECT {key}, '#' || array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND {width - 1}))"""


NEAR_DUP_SQL = f"""WITH RECURSIVE {shingle_sql(4)},
      sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
      shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
      links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
      reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
      least AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM documents d JOIN least USING (doc_id) LEFT JOIN sizes USING (doc_id)"""


@_query("op6_near_dup", NEAR_DUP_SQL)
def op6_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(_table(spark, sf_dir, "documents"), width=4, percent=80)


LEAKS_SQL = f"""WITH {shingle_sql(5)},
      item_words AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM benchmark),
      item_shingles AS (SELECT DISTINCT item_id, s FROM (
        SELECT item_id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3] || ' ' || w[i + 4] AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS i FROM item_words WHERE len(w) >= 5)
        UNION ALL SELECT item_id, '#' || array_to_string(w, ' ') FROM item_words WHERE len(w) BETWEEN 1 AND 4)),
      sizes AS (SELECT item_id, count(*) AS item_size FROM item_shingles GROUP BY item_id),
      shared AS (SELECT doc_id, item_id, count(*) AS shared FROM shingles JOIN item_shingles USING (s) GROUP BY 1, 2)
    SELECT doc_id, item_id, shared::BIGINT AS shared, item_size::BIGINT AS item_size FROM shared JOIN sizes USING (item_id) WHERE 100 * shared >= 80 * item_size"""


@_query("op10_decontaminate", LEAKS_SQL)
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("mark")


def _held_out(folds: int, fold: int) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


@_query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.fit_from_labels(docs, labels.where(~_held_out(3, 1)))
    scored = toxicity.score(docs, model)
    predicted = (F.col("score") >= 0.7).cast("int")
    return scored.select("doc_id", _held_out(3, 1).alias("held_out"), "score", predicted.alias("predicted"), F.size("spans").alias("n_spans"))


_ASSIGN = "(?i:(password|passwd|secret|token|api_?key)[\"'']?\\x20*[:=]\\x20*[\"'']?)([A-Za-z0-9+/_.=-]+)"


def _span_sql(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    return f"""SELECT doc_id, '{kind}' AS kind, {rank} AS rank, kept,
        sum(gap) OVER w + coalesce(sum(whole) OVER b, 0) AS start, whole FROM (
          SELECT doc_id, length(unnest(string_split_regex(text, '{pattern}'))) AS gap, length(unnest(regexp_extract_all(text, '{pattern}', 0))) AS whole,
            length(unnest(regexp_extract_all(text, '{pattern}', {group}))) >= {least} AS kept, generate_subscripts(string_split_regex(text, '{pattern}'), 1) AS i FROM docs)
        WINDOW w AS (PARTITION BY doc_id ORDER BY i), b AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


SECRETS_SQL = f"""WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
      found AS ({_span_sql("assign", 0, _ASSIGN, 2, 6)} UNION ALL {_span_sql("access", 1, "AKIA[A-Z0-9]+", 0, 20)} UNION ALL {_span_sql("hex", 2, "[0-9a-f]+", 0, 24)}
        UNION ALL {_span_sql("private_key", 3, "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 1)}
        UNION ALL {_span_sql("web_token", 4, "eyJ[A-Za-z0-9_-]{10,}[.]eyJ[A-Za-z0-9_-]{10,}[.][A-Za-z0-9_-]{10,}", 0, 1)}
        UNION ALL {_span_sql("service_token", 5, "(?:ghp|gho|ghs|xoxb|xoxp)[_-][A-Za-z0-9-]{20,}", 0, 1)}),
      spans AS (SELECT doc_id, kind, rank, start, kind || ':' || start::BIGINT || ':' || (start + whole)::BIGINT AS span FROM found WHERE kept),
      per AS (SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
        string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3) AS base, string_agg(span, ',' ORDER BY start, rank) AS spans FROM spans GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
      sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents LEFT JOIN per USING (doc_id)"""


@_query("op3_secrets", SECRETS_SQL)
def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    base = secrets.listed(F.filter("spans", lambda s: s["kind_rank"] < len(secrets.BASE_RULES)))
    return found.select("doc_id", *map(count, ("assign", "access", "hex")), F.sha2(base, 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


@F.pandas_udf(T.StringType())
def _ids_digest(ids: pd.Series) -> pd.Series:
    return ids.map(lambda x: hashlib.sha256(np.asarray(x).astype("<u4").tobytes()).hexdigest())


@_query("op7_bpe")
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_documents(_table(spark, sf_dir, "documents"), bpe.load(public_tokenizers.path("byte_bpe_50k.json")))
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), _ids_digest("ids").alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@_query("op1_language")
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    profiles = language.fit(docs.where(~_held_out(3, 1)))
    found = language.identify(docs, profiles)
    return found.select("doc_id", _held_out(3, 1).alias("held_out"), "lang_pred", "score", F.size("mixture").alias("n_languages"))


@_query("op2_quality")
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = materialise(quality.statistics(_table(spark, sf_dir, "documents")), "statistics")
    ensemble = quality.fit(measured, _table(spark, sf_dir, "labels").where(~_held_out(4, 2)))
    return quality.score(measured, ensemble).select("doc_id", _held_out(4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


TOP_K_SQL = """WITH v AS (SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT for x in embedding] AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
      scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id),
      ranked AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""


@_query("op9_top_k", TOP_K_SQL)
def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


#: What a privacy pass would put in the place of addresses and long numbers.
ADDRESS = "[A-Za-z0-9_]+(?:[.][A-Za-z0-9_]+)*@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+"
LONG_NUMBER = "[0-9]{9,}"


@_query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    edits = token_counts.edits_of(F.col("text"), f"(?:{ADDRESS})|(?:{LONG_NUMBER})", "<private>")
    counted = token_counts.recount(docs, edits, bpe.load(public_tokenizers.path("byte_bpe_50k.json")))
    return counted.select("doc_id", "n_before", "n_edits", "n_after", "n_renewed", F.sha2("text", 256).alias("text_sha256"))


@_query("op5_html_text")
def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


REPEATS_SQL = """WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
      pieces AS (SELECT r, p, substr(x, 2 * p + 1, 2446) AS x FROM (SELECT r, x, unnest(range(0, length(x) // 2 - 199, 1024)) AS p FROM d WHERE length(x) >= 400)),
      heads AS (SELECT r, p + i AS i, md5(substr(x, 2 * i + 1, 400)) AS s FROM (SELECT r, p, x, unnest(range(0, length(x) // 2 - 199)) AS i FROM pieces)),
      twice AS (SELECT s FROM heads GROUP BY s HAVING count(*) > 1),
      hit AS (SELECT r, i, i > lag(i, 1, -1000) OVER (PARTITION BY r ORDER BY i) + 200 AS new FROM heads SEMI JOIN twice USING (s)),
      spans AS (SELECT r, min(i) AS a, max(i) + 200 AS b FROM (SELECT r, i, sum(new::INT) OVER (PARTITION BY r ORDER BY i) AS g FROM hit) GROUP BY r, g),
      gaps AS (SELECT r, a, b, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM spans),
      cut AS (SELECT r, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last, string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept FROM gaps JOIN d USING (r) GROUP BY r)
    SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
      sha256(unhex(coalesce(kept, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN cut USING (r)"""


@_query("op11_suffix_dedup", REPEATS_SQL)
def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"), length=200)
    return left.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def _planted(docs: DataFrame) -> DataFrame:
    """Every tenth document, by its digest, repeats its words from some word on: the contract's own test cases."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != ""))
    split = docs.select("doc_id", "text", words.alias("w")).withColumns({"n": F.size("w"), "g": F.floor(h / 10).cast("bigint")})
    a = F.pmod("g", "n").cast("int")
    split = split.withColumn("a", F.when(F.col("n") > 0, a)).withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    repeated = F.concat(F.slice("w", F.lit(1), F.col("a")), F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), times)))
    return split.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(F.slice(repeated, F.lit(1), F.col("n")), " ")).otherwise(F.col("text")).alias("text"))


@_query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(_planted(_table(spark, sf_dir, "documents")), least=12)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("brief"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    rows = found.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), best.alias("best"), F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = F.col("best.length"), -F.col("best.brief")
    return rows.select(
        "doc_id", "n_runs", (-F.col("best.back")).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).cast("bigint").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


@_query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(_table(spark, sf_dir, "embeddings"), components=32, scale=64.0, shift=1_000_000)
    return white.withColumn("deviation", F.col("deviation").cast("bigint"))
