"""Every operator on nulls, empty and very long texts, repeated rows, empty tables, and columns with clashing names."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabwright.llm import bpe, decontaminate, html_text, language, near_dup, quality, secrets, token_counts, top_k, toxicity, words

LONG = "lorem ipsum dolor sit amet " * 40_000
DOCS = [(1, "one two three four five six"), (2, None), (3, ""), (4, "   \n\t "), (None, "one two three four five six"), (1, "one two three four five six"), (5, LONG), (6, "é"), (7, "12 !!")]
CLASH = ("score", "spans", "ids", "decoded", "row", "mark", "node", "unit", "digest", "kept", "rules", "edits", "item_id", "lang", "label", "_id", "_mark", "_row", "trigram", "a.b")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string").withColumns({c: F.lit("x") for c in CLASH})


@pytest.fixture(scope="module")
def codec():
    import public_tokenizers

    return bpe.load(public_tokenizers.path("byte_bpe_50k.json"))


def ids(rows, key="doc_id"):
    return sorted((r[key] is None, r[key] or 0) for r in rows)


ALL = ids([{"doc_id": d} for d, _ in DOCS])


def test_near_dup(docs):
    rows = near_dup.near_duplicates(docs).collect()
    assert ids(rows) == ALL
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["component_id"] == 1 and by[1]["n_shingles"] == 2 and by[1]["kept"]
    assert by[None]["component_id"] is None and not by[None]["kept"]
    assert all(by[k]["n_shingles"] == 0 and by[k]["component_id"] == k and by[k]["kept"] for k in (2, 3, 4))
    assert by[5]["n_shingles"] == 5 and by[6]["n_shingles"] == 1
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_keep_one(docs):
    rows = near_dup.keep_one(docs)
    assert rows.columns == docs.columns
    assert ids(rows.collect()) == ids([{"doc_id": d} for d in (1, 2, 3, 4, 5, 6, 7, None)])


def test_keep_one_does_not_depend_on_order(spark):
    rows = [(1, f"text {k} of the same id and more words", k) for k in range(12)] + [(2, "another text of five words", 0)]
    kept = [sorted(map(tuple, near_dup.keep_one(spark.createDataFrame(rows, "doc_id long, text string, `a.b` int").repartition(n)).collect())) for n in (1, 2, 5)]
    assert kept[0] == kept[1] == kept[2] and [r[0] for r in kept[0]] == [1, 2]


def test_items_are_sketched_after_they_are_united(spark):
    """Rows of one item share their smallest hashes; a document holds 54 of the 67 united shingles."""
    words_ = [f"w{k}" for k in range(71)]
    order = sorted(range(67), key=lambda k: words.hash_shingles(words.as_text(pa.array([" ".join(words_[k : k + 5])])), 5)[1].view("int64")[0])
    lacked = set(order[:13])
    items = spark.createDataFrame([(1, " ".join(words_)), (1, " ".join(words_[:40]))], "item_id long, text string")
    text = " . ".join(" ".join(words_[k : k + 5]) for k in range(67) if k not in lacked)
    found = decontaminate.leaks(spark.createDataFrame([(1, text)], "doc_id long, text string"), items).collect()
    assert [(r["doc_id"], r["item_id"], r["shared"], r["item_size"]) for r in found] == [(1, 1, 54, 67)]
    halves = spark.createDataFrame([(1, " ".join(words_[:40])), (1, " ".join(words_[35:]))], "item_id long, text string")
    assert decontaminate.leaks(spark.createDataFrame([(1, text)], "doc_id long, text string"), halves).count() == 1


def test_decontaminate(spark, docs):
    items = spark.createDataFrame([(1, "one two three four five six"), (2, None), (3, ""), (4, "12 !!"), (None, "é")], "item_id long, text string").withColumn("shingle", F.lit(0))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, items).collect()}
    assert found == {(1, 1), (None, 1), (7, 4), (6, None)}
    assert decontaminate.leaks(docs, items, sent_shingles=0).count() == 4
    clean = decontaminate.drop_leaking(docs, items)
    assert clean.columns == docs.columns and ids(clean.collect()) == ids([{"doc_id": d} for d in (2, 3, 4, 5)])
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0 and decontaminate.leaks(docs.limit(0), items).count() == 0


def test_secrets(docs):
    rows = secrets.find_secrets(docs).collect()
    assert ids(rows) == ALL and all(r["spans"] == [] for r in rows)
    assert ids(secrets.redact(docs).collect()) == ALL and secrets.find_secrets(docs.limit(0)).count() == 0


def test_bpe(docs, codec):
    rows = bpe.encode_documents(docs, codec).collect()
    assert ids(rows) == ALL
    assert {(r["doc_id"], r["decoded"]) for r in rows} == {(d, t or "") for d, t in DOCS}
    assert bpe.encode_documents(docs.limit(0), codec).count() == 0


def test_token_counts(docs, codec):
    edits = F.when(F.col("doc_id") == 1, F.expr("array(struct(0L as start, 3L as end, 'eleven' as replacement))"))
    rows = token_counts.recount(docs, edits, codec).collect()
    assert ids(rows) == ALL
    by = {r["doc_id"]: r for r in rows}
    assert by[1]["n_after"] == len(codec.encode("eleven two three four five six")) and by[1]["n_renewed"] <= 3
    assert by[5]["n_before"] == by[5]["n_after"] == len(codec.encode(LONG)) and by[2]["n_before"] == 0
    assert token_counts.recount(docs.limit(0), edits, codec).count() == 0


def test_toxicity(docs):
    model = toxicity.fit(["you scum", "scum and trash", "fine words", "more fine words"] * 8, [1, 1, 0, 0] * 8, least=2)
    rows = toxicity.score(docs, model).collect()
    assert ids(rows) == ALL and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.drop_toxic(docs, model).columns == docs.columns
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.fit([], []).curve[0] == pytest.approx(0) and toxicity.fit(["a"], [1]).weights == {}


def test_language(docs):
    profiles = language.fit(docs.withColumn("lang", F.when(F.col("doc_id") == 5, "la").otherwise("en")))
    rows = language.identify(docs, profiles).collect()
    assert ids(rows) == ALL
    by = {r["doc_id"]: r["lang_pred"] for r in rows}
    assert by[5] == "la" and by[1] == "en" and {by[k] for k in (2, 3, 4, 7)} == {"und"}
    nothing = language.fit(docs.limit(0))
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}


def test_quality(spark, docs):
    measured = quality.statistics(docs)
    assert ids(measured.collect()) == ALL
    labels = spark.createDataFrame([(1, 1), (None, 0)], "doc_id long, quality int")
    rows = quality.score(measured, quality.fit(measured, labels)).collect()
    assert ids(rows) == ALL and all(0 <= r["score"] <= 1 for r in rows)


def test_top_k(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5]), (3, None), (4, [1.0, None]), (5, [float("nan"), 1.0]), (None, [9.0, 9.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (40, [])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({c: F.lit(1) for c in ("score", "rank", "group", "part")})
    found = [tuple(r) for r in top_k.top_k(table, F.col("vec_id") % 20 == 0, k=2).orderBy("query_id", "rank").collect()]
    assert found == [(0, 1, 1, 4096), (0, 2, 20, 4096), (20, 1, 0, 4096), (20, 2, 1, 4096), (40, 1, 0, 0), (40, 2, 1, 0)]
    assert top_k.top_k(table.limit(0), F.lit(True)).count() == 0


def test_top_k_refuses_scores_beyond_64_bits(spark):
    table = spark.createDataFrame([(0, [1e9, 1.0]), (1, [-1e9, 2.0]), (20, [2.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="64-bit"):
        top_k.top_k(table, F.lit(True))
    small = spark.createDataFrame([(0, [1e7, 1.0]), (1, [-1e7, 2.0])], "vec_id long, embedding array<double>")
    assert top_k.top_k(small, F.col("vec_id") == 0).first()["score"] == -(64 * 10**7) ** 2 + 64 * 128


def test_html(spark):
    pages = spark.createDataFrame([(1, "<p>a"), (2, None), (3, ""), (1, "<p>a"), (None, "plain"), (4, "<div>" * 5000 + "deep"), (5, "<" * 1000), (6, "x" * 10**6)], "page_id long, html string").withColumn("text", F.lit("x"))
    found = {(r["page_id"], r["text"]) for r in html_text.extract(pages).collect()}
    assert found == {(1, "a"), (2, ""), (3, ""), (None, "plain"), (4, "deep"), (5, "<" * 1000), (6, "x" * 10**6)}
    assert html_text.extract(pages).count() == 8 and html_text.extract(pages.limit(0)).count() == 0
