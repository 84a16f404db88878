"""The pipeline's stages against brute force on a small corpus with planted cases."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from test_methods import brute_spans, clusters, prose, shingles

import corpus_pipeline

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(21)
    texts, toxic = {}, {}
    for k in range(160):
        w = prose(rng, rng.randint(30, 80)).split()
        toxic[k] = int(k % 4 == 0)
        for _ in range(3 * toxic[k]):
            w.insert(rng.randrange(len(w)), rng.choice(["zwurbish", "plonktic"]))
        texts[k] = " ".join(w)
    items = {k: prose(rng, 25) for k in range(5)}
    for k in range(160, 200):
        base = texts[rng.choice([x for x in texts if not toxic.get(x, 0)])]
        texts[k] = {0: base + " tail", 1: base, 2: prose(rng, 30) + " " + items[k % 5] + " end", 3: prose(rng, 20) + " token = " + "ab12" * 9}[k % 4]
    base = str(tmp_path_factory.mktemp("sf"))
    rows = [(k, t, "xx", "s", len(t)) for k, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(k, 1, v) for k, v in toxic.items()], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame(list(items.items()), "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base, texts, toxic, items


def test_stages_do_what_brute_force_does(spark, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer

    base, texts, toxic, items = corpus
    left = {k: t for k, t in texts.items() if not toxic.get(k)}
    root = clusters(left, 5, 80)
    left = {k: t for k, t in left.items() if root[k] == k}
    left = {k: t for k, t in left.items() if not any(100 * len(shingles(i, 5) & shingles(t, 5)) >= 80 * len(shingles(i, 5)) for i in items.values())}
    assert 80 < len(left) < 140
    for k, t in left.items():
        spans = brute_spans(t)
        if spans:
            start, end = spans[0][0], max(s[2] for s in spans)
            left[k] = t[:start] + "[secret]" + t[end:]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = corpus_pipeline.run(spark, base).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == {k: library.encode(t, add_special_tokens=False).ids for k, t in left.items()}
    assert all(r["round_trip"] and r["n_chars"] == len(left[r["doc_id"]]) and r["n_tokens"] == len(r["ids"]) for r in got)
    assert any("[secret]" in t for t in left.values())


def test_stages_keep_the_columns_of_documents(spark, corpus):
    base = corpus[0]
    docs = spark.read.parquet(f"{base}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, base).columns == docs.columns
        assert stage(spark, docs.limit(0), base).count() == 0


def test_queries_digest_what_operators_give(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    from tabwright.llm import queries

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.QUERIES["op7_bpe"](spark, SF).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest())
    counted = queries.QUERIES["op4_token_counts"](spark, SF)
    for r in counted.where(F.col("n_edits") > 0).collect():
        assert r["n_before"] == len(library.encode(texts[r["doc_id"]], add_special_tokens=False).ids) and r["n_renewed"] < 40 * r["n_edits"]


def test_any_rows_and_any_columns_pass(spark, corpus):
    """Nulls, empty texts, repeated rows and columns of clashing and dotted names in every stage."""
    base = corpus[0]
    rows = [(1, "one two three four five six"), (1, "one two three four five six"), (2, None), (3, ""), (None, None), (None, "lost words here and there again"), (4, "token = " + "ab12" * 9)]
    names = ("ids", "decoded", "_digest", "n_tokens", "round_trip", "row", "_id", "_mark", "a.b", "spans", "score", "_row", "label")
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("x") for c in names})
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, base)
        assert left.columns == docs.columns, name
    out = corpus_pipeline.encode(spark, left, base)
    assert out.columns == [c for c in docs.columns if c not in ("text", "n_tokens", "ids", "round_trip")] + ["n_tokens", "ids", "round_trip"]
    assert sorted(r["doc_id"] or 0 for r in out.collect()) == [0, 0, 1, 2, 3, 4] and out.where("round_trip and `a.b` = 'x'").count() == 6
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), base).count() == 0
