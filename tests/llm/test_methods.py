"""The operators against brute force, the library whose ids they must give, or planted cases."""

import random
import re
import time
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabwright.llm import bpe, decontaminate, html_text, language, near_dup, quality, queries, secrets, token_counts, top_k, toxicity, trigrams, words
from tabwright.llm.components import components

SF = "/root/testdata/sf0.001"
SYLLABLES = [a + b for a in "bdfgklmnprst" for b in "aeiou"]


def prose(rng, n):
    return " ".join("".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4))) for _ in range(n))


def shingles(text, width):
    w = re.findall("[^\x20\x09-\x0d]+", text.translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def test_words_of_slices():
    texts = ["A b", None, "", "É\x1cx\tÀ  y", "z" * 50] * 3
    for low, high in ((0, 15), (2, 9), (7, 15)):
        bounds, distinct, index = words.words_of(words.as_text(pa.array(texts).slice(low, high - low)))
        got = [[distinct[i].as_py() for i in index[a:b]] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        assert got == [re.findall("[^\x20\x09-\x0d]+", (t or "").translate({c: c + 32 for c in range(65, 91)})) for t in texts[low:high]]


@pytest.mark.parametrize("width", [1, 4, 5])
def test_shingle_counts(width):
    rng = random.Random(width)
    texts = [prose(rng, n) for n in (0, 1, 3, 4, 5, 6, 40)] + ["a a a a a a a a"]
    bounds, _ = words.distinct_sets(*words.hash_shingles(words.as_text(pa.array(texts)), width))
    assert np.diff(bounds).tolist() == [len(shingles(t, width)) for t in texts]


def clusters(texts, width, percent):
    sets = {k: shingles(t, width) for k, t in texts.items()}
    root = {k: k for k in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in texts:
        for b in texts:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in texts}


@pytest.fixture(scope="module")
def copies():
    """Groups of near copies of many similarities, chains, exact copies, and a passage that all texts share."""
    rng = random.Random(3)
    texts, shared = {}, prose(rng, 12)
    for group in range(25):
        text = prose(rng, rng.randint(20, 120)).split()
        for _ in range(rng.choice([1, 2, 5, 14])):
            texts[len(texts) * 7 % 1009] = " ".join([shared, *text])
            for _ in range(rng.randint(0, 2)):
                text[rng.randrange(len(text))] = prose(rng, 1)
    return texts


@pytest.mark.parametrize("limits", [{}, {"leaf": 4, "block": 8, "depth": 3}])
def test_near_dup_is_exact(spark, copies, limits):
    docs = spark.createDataFrame(list(copies.items()), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dup.near_duplicates(docs, width=4, **limits).collect()}
    want = clusters(copies, 4, 80)
    assert got == want and len(set(want.values())) < len(want)


def met(spark, shares, **limits):
    """Pairs that meet in a unit, of pairs that share the smallest hash in the marked coordinates only."""
    rows = []
    for pair, row in enumerate(shares):
        for side in (0, 1):
            rows.append((b"%d" % (2 * pair + side), 10, [1000 * pair + c + (0 if same else 500 * side) for c, same in enumerate(row)]))
    classes = spark.createDataFrame(rows, "digest binary, n_shingles long, mins array<int>")
    units = near_dup._leaves(classes, 4, 3, percent=80, **limits).dropDuplicates().toArrow().to_pandas()
    by = units.groupby("unit")["digest"].agg(lambda x: sorted(int(d) for d in x))
    return {x[0] // 2 for x in by if len(x) == 2 and x[0] // 2 == x[1] // 2}


def test_a_small_first_node_is_compared(spark):
    assert met(spark, [[c == 0 for c in range(64)], [c == 60 for c in range(64)]], leaf=512, block=768) == {0}


def test_trees_miss_independently(spark):
    rng = np.random.default_rng(5)
    pairs = 4000
    found = met(spark, (rng.random((pairs, 64)) < 0.5).tolist(), leaf=1, block=768)
    assert abs((pairs - len(found)) / pairs - 0.4834**4) < 0.012  # 1 - q(3) at s = 0.5, four trees


def test_the_screen_drops_only_what_cannot_be_linked():
    least = near_dup.least_shared(56, 80)
    assert 15 < least < 30 and near_dup.least_shared(56, 100) == 56
    rng = np.random.default_rng(2)
    marks = rng.integers(0, 128, (4, 56)).astype(np.int8)
    marks[1, :45], marks[3, :45] = marks[0, :45], marks[0, :45]
    rows = {"node": [1] * 4, "digest": [b"a", b"b", b"c", b"d"], "n_shingles": [1000, 900, 1000, 500], "marks": pa.array(list(marks), pa.list_(pa.int8()))}
    assert near_dup._screened(80)(pa.table(rows)).to_pylist() == [{"node": 1, "digest": x, "size": 2, "total": 1900} for x in (b"a", b"b")]


def test_shared_counts():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 300, n)).astype(np.uint64) for n in (5, 60, 200, 1, 90)]
    want = [[len(np.intersect1d(a, b)) for b in sets] for a in sets]
    assert near_dup.shared_counts(sets, step=16).astype(int).tolist() == want


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(40)]
    star = [(100, k) for k in range(101, 160)] + [(None, 7), (5, 5)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect())
    assert found == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 160)}


def test_leaks_are_exact(spark):
    rng = random.Random(8)
    items = {k: prose(rng, rng.choice([3, 5, 8, 30, 70])) for k in range(30)}
    docs = {}
    for k, item in items.items():
        w = item.split()
        for drop in (0, 1, len(w) // 8, len(w) // 4):
            kept = w[: len(w) - drop]
            parts = [prose(rng, 50), " ".join(kept[: len(kept) // 2]), *([prose(rng, 3)] if drop > 1 else []), " ".join(kept[len(kept) // 2 :]), prose(rng, 400)]
            docs[len(docs)] = " ".join(parts if k % 3 else [item])
    want = {(d, i) for d, t in docs.items() for i, x in items.items() if 100 * len(shingles(x, 5) & shingles(t, 5)) >= 80 * len(shingles(x, 5))}
    frames = (spark.createDataFrame(list(x.items()), f"{n} long, text string") for x, n in ((docs, "doc_id"), (items, "item_id")))
    d, i = frames
    for sent in (2_000_000, 0):
        assert {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(d, i, sent_shingles=sent).collect()} == want
    assert len(want) > 40


def test_trigram_queries_never_miss():
    for rule in secrets.BASE_RULES + secrets.MORE_RULES:
        query = trigrams.query_of(rule.pattern)
        assert query.scans_all == (rule.kind == "hex")
    for pattern, text in (("ab?c{2}d", "xACCDx"), ("(?:foo|ba[rz])qux+", "bazquxx"), ("a.*bcd", "a--bcd"), ("x{0,2}yzw", "yzw"), ("(abc)?def", "def")):
        found = trigrams.query_of(f"(?i){pattern}")
        assert re.search(pattern, text, re.I) and any(all(t in text.lower() for t in a) for a in found.alternatives)


SECRETS = ["token = 'abcdef123'", "pass" + "word: x", "token: token: abcdefgh", "API_KEY=\"" + "k" * 20 + "\" Secret:zzzzzz", "é AKIA" + "Q" * 16 + "z", "AKIA" + "Q" * 15, "x" + "0123456789abcdef" * 2, "abc " * 30, "-----BEGIN RSA PRIVATE KEY-----", "🙂 token=" + "0a" * 15, ""]


def brute_spans(text):
    assign = r"(?ai:(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?)([A-Za-z0-9+/_.=-]+)"
    out = [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def test_secret_spans_and_cover(spark):
    docs = spark.createDataFrame(list(enumerate(SECRETS)), "doc_id long, text string")
    for r in secrets.find_secrets(docs).collect():
        base = [(s["start"], s["kind_rank"], s["end"]) for s in r["spans"] if s["kind_rank"] < 3]
        assert base == brute_spans(SECRETS[r["doc_id"]])
    covered = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert covered[0] == "[secret]'" and covered[3] == '[secret]" [secret]' and covered[4] == "é [secret]z" and covered[9] == "🙂 [secret]" and covered[7] == SECRETS[7]


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    return bpe.load(path), Tokenizer.from_file(path)


def test_bpe_gives_the_ids_of_the_library(tokenizer):
    codec, library = tokenizer
    rng = random.Random(1)
    parts = ["a", "b", "é", " ", "  ", "\n", "\t", "'s", "'ll", "'S", "1", "23", "<|endoftext|>", "<|endof", "漢", "🙂", "‍", "\x1c", "\x85", "\xa0", "--", "!!", "　", " the", "###", "internationalization"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    texts += ["a" + chr(c) + " " + chr(c) + chr(c) + "\n " + chr(c) for c in range(0, 0x3000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(rng.choice("abcdefgh") for _ in range(n)) for n in (*range(120), 20_000)]
    bounds, ids = codec.encode_all(texts)
    for k, found in enumerate(library.encode_batch(texts, add_special_tokens=False)):
        own = ids[bounds[k] : bounds[k + 1]].tolist()
        assert own == found.ids, texts[k]
        assert codec.decode(own) == texts[k]
    assert codec.decode([127, 200]) == library.decode([127, 200], skip_special_tokens=False)


def test_edits_count_as_a_whole_text_does(tokenizer, monkeypatch):
    codec, _ = tokenizer
    monkeypatch.setattr(token_counts, "CHUNK", 3)
    rng = random.Random(3)
    parts = ["a", "b", "é", " ", "  ", "\n", "'s", "'ll", "1", "23", "<|endoftext|>", "<|endof", "text|>", "漢", "!!", "the", " the", "###"]

    def text(n):
        return "".join(rng.choice(parts) for _ in range(rng.randint(0, n)))

    for _ in range(400):
        s, edits, at = text(30), [], 0
        while at <= len(s) and rng.random() < 0.7:
            start = rng.randint(at, len(s))
            end = rng.randint(start, min(len(s), start + 4))
            edits.append({"start": start, "end": end, "replacement": rng.choice([None, text(4)])})
            at = end + 1
        ((lengths, tokens),) = codec.pre_tokens([s])
        want = s
        for e in reversed(edits):
            want = want[: e["start"]] + (e["replacement"] or "") + want[e["end"] :]
        before, n, after, _, got = token_counts._recounted(codec, s, lengths, tokens, edits)
        assert (got, before, after, n) == (want, len(codec.encode(s)), len(codec.encode(want)), len(edits))


def test_an_edit_renews_only_its_neighbourhood(tokenizer):
    codec, _ = tokenizer
    text = prose(random.Random(2), 20_000)
    ((lengths, tokens),) = codec.pre_tokens([text])
    middle = len(text) // 2
    assert token_counts._recounted(codec, text, lengths, tokens, [{"start": middle, "end": middle + 3, "replacement": "changed"}])[3] < 10
    with pytest.raises(ValueError):
        token_counts._recounted(codec, text, lengths, tokens, [{"start": 0, "end": 5, "replacement": ""}, {"start": 3, "end": 8, "replacement": ""}])


def test_marginals_are_those_of_all_paths():
    rng = np.random.default_rng(4)
    moves = rng.normal(0, 1, (2, 2))
    bounds = np.array([0, 4, 4, 5, 11])
    scores = rng.normal(0, 2, 11)
    got = toxicity.marginals(scores, bounds, moves)
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        total, on = 0.0, np.zeros(b - a)
        for path in range(1 << (b - a)):
            bits = [path >> k & 1 for k in range(b - a)]
            weight = np.exp(sum(scores[a + k] for k in range(b - a) if bits[k]) + sum(moves[x, y] for x, y in zip(bits[:-1], bits[1:], strict=True)))
            total += weight
            on += weight * np.array(bits)
        assert np.allclose(got[a:b], on / total)


def held_out(frame, folds, fold):
    return np.array([zlib.crc32(str(i).encode()) % folds == fold for i in frame["doc_id"]])


def test_every_window_takes_part():
    words_ = ["zwurb"] + ["calm"] * 99 + ["zwurb"] + ["calm"] * 99
    seen = toxicity.Tagged()
    seen.add(" ".join(words_ * 4), True, {"=zwurb"})
    seen.add(" ".join(["fine"] * 40 + ["zwurb"] * 2), False, {"=zwurb"})
    assert sum(map(sum, seen.tags)) == 8 and len(seen.windows) == 9 and seen.tags[-1] == [0] * 10
    assert sum(map(len, seen.windows)) + sum(seen.rest.values()) == 842 and seen.rest["fine"] == 32


def test_a_toxic_passage_far_into_a_text(spark):
    """Two of the telling words occur behind the fourth marked window only, and the field learns them."""
    rng = random.Random(12)
    rows = []
    for k in range(240):
        w = prose(rng, 400).split()
        if k % 4 == 0:
            for at in (10, 50, 90, 130, 170):
                w[at] = "zwurb"
            w[350:352] = ["plonktic", "grelk"]
        rows.append((k, " ".join(w), int(k % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_from_labels(docs, docs)
    late = [(1000 + k, " ".join([prose(rng, 380), "plonktic grelk", prose(rng, 5)])) for k in range(6)]
    spans = toxicity.score(spark.createDataFrame(late, "doc_id long, text string"), model).collect()
    assert all(any("plonktic" in t[s["start"] : s["end"]] for s in r["spans"]) for r in spans for i, t in late if i == r["doc_id"])


def test_equal_texts_with_unequal_labels_are_toxic(spark):
    rng = random.Random(13)
    rows = [(k, "zwurb calm words", k % 2) for k in range(40)] + [(100 + k, prose(rng, 20), 0) for k in range(60)] + [(200 + k, prose(rng, 20) + " zwurb", 1) for k in range(30)]
    models = []
    for parts in (1, 2, 5):
        docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(parts)
        models.append(toxicity.fit_from_labels(docs, docs))
    assert models[0] == models[1] == models[2] and models[0].curve[1:] != (0.0, 0.0, 0.0)
    both = [(k, "one text", k % 2) for k in range(40)]
    docs = spark.createDataFrame(both, "doc_id long, text string, toxic int")
    assert toxicity.fit_from_labels(docs, docs).curve[0] > 0


def test_labels_weigh_as_they_occur(spark):
    """Fewer chosen texts of the frequent label leave the score of evidence about where it was."""
    rng = random.Random(14)
    rows = [(k, prose(rng, 30) + (" zwurb zwurbing" if k % 8 == 0 else " zwurb" if k % 9 == 1 else ""), int(k % 8 == 0)) for k in range(1200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    probe = spark.createDataFrame([(0, prose(rng, 30))], "doc_id long, text string")
    whole, some = (toxicity.score(probe, toxicity.fit_from_labels(docs, docs, per_label=n)).first()["score"] for n in (1500, 150))
    assert whole < 0.15 and some < 0.15


def test_toxic_documents_are_found(spark):
    rng = random.Random(11)
    rows = []
    for k in range(600):
        w = prose(rng, rng.randint(30, 150)).split()
        toxic = k % 5 == 0
        for _ in range(rng.randint(2, 5) if toxic else k % 11 == 0):
            w.insert(rng.randrange(len(w)), rng.choice(["zwurb", "zwurbing", "plonktic", "Grelk!"]) if toxic else "zwimo")
        rows.append((k, " ".join(w), int(toxic)))
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "toxic"])
    held = held_out(frame, 3, 1)
    docs = spark.createDataFrame(frame[["doc_id", "text"]])
    model = toxicity.fit_from_labels(docs, spark.createDataFrame(frame[~held][["doc_id", "toxic"]]))
    got = toxicity.score(docs, model).toPandas().merge(frame, on="doc_id")
    assert ((got["score"] >= 0.7) == (got["toxic"] == 1))[held_out(got, 3, 1)].mean() > 0.97
    first = got[(got["toxic"] == 1) & (got["score"] >= 0.7)].iloc[0]
    assert any(re.search("zwurb|plonk|grelk", first["text"][s["start"] : s["end"]].lower()) for s in first["spans"])
    assert toxicity.drop_toxic(docs, model).count() == (got["score"] < 0.7).sum()


def test_mixtures_of_languages(spark):
    rng = random.Random(5)
    sounds = {"aa": "aeimnrst", "bb": "oukgzpw", "cc": "yxqvjdh"}

    def say(lang, n):
        return " ".join("".join(rng.choice(sounds[lang]) for _ in range(rng.randint(3, 8))) for _ in range(n))

    learned = spark.createDataFrame([(say(x, 80), x) for x in sounds for _ in range(20)], "text string, lang string")
    profiles = language.fit(learned)
    assert profiles.languages == ["aa", "bb", "cc"]
    texts = {0: say("aa", 30), 1: say("bb", 60) + " " + say("cc", 30), 2: say("cc", 1), 3: say("aa", 50) + " " + say("bb", 25) + " " + say("cc", 25)}
    got = {r["doc_id"]: r for r in language.identify(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), profiles).collect()}
    shares = {k: {m["lang"]: m["share"] for m in r["mixture"]} for k, r in got.items()}
    assert shares[0] == {"aa": 1.0} and list(shares[2]) == ["cc"]
    assert shares[1] == {"bb": pytest.approx(2 / 3, abs=0.02), "cc": pytest.approx(1 / 3, abs=0.02)} and got[1]["lang_pred"] == "bb"
    assert shares[3] == {"aa": pytest.approx(0.5, abs=0.02), "bb": pytest.approx(0.25, abs=0.02), "cc": pytest.approx(0.25, abs=0.02)}


def test_tree_paths_become_rules():
    tree = "DecisionTree\n  If (feature 0 <= 0.5)\n   If (feature 6 <= 0.1)\n    Predict: 0.0\n   Else (feature 6 > 0.1)\n    Predict: 1.0\n  Else (feature 0 > 0.5)\n   Predict: 0.0\n"
    upper, cry = quality.STATISTICS[0], quality.STATISTICS[6]
    assert {r.terms for r in quality.tree_rules(tree)} == {((upper, False, 0.5),), ((upper, True, 0.5),), ((cry, False, 0.1), (upper, False, 0.5)), ((cry, True, 0.1), (upper, False, 0.5))}


def test_quality_rules_separate_shouting(spark):
    rng = random.Random(9)
    rows = [(k, prose(rng, 40).upper() + "!!" if k % 3 == 0 else prose(rng, 40) + ".", int(k % 3 != 0)) for k in range(240)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    measured = quality.statistics(docs)
    ensemble = quality.fit(measured, spark.createDataFrame([(r[0], r[2]) for r in rows[:160]], "doc_id long, quality int"), trees=4)
    got = {r["doc_id"]: r["score"] for r in quality.score(measured, ensemble).collect()}
    assert all((got[k] >= 0.7) == bool(y) for k, _, y in rows) and 0 < len(ensemble.rules) < 20


@pytest.mark.parametrize("shape", ["round", "hot", "large"])
def test_top_k_is_exact(spark, shape):
    rng = np.random.default_rng(2)
    vectors = rng.normal(0, 0.3 if shape != "large" else 3e5, (300, 8))
    if shape == "hot":
        vectors[50:200] = vectors[0]
    table = spark.createDataFrame([(int(k), v.tolist()) for k, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    found = top_k.top_k(table, F.col("vec_id") % 20 == 0, k=7, block=16, blocks_per_cell=4, queries_per_cell=4, sample=50)
    got = sorted(tuple(r) for r in found.collect())
    ints = np.floor(64 * vectors).astype(np.int64)
    want = []
    for q in range(0, 300, 20):
        best = sorted((-int(ints[q] @ ints[c]), c) for c in range(300) if c != q)[:7]
        want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(best)]
    assert got == sorted(want)


def test_an_id_of_many_vectors_leaves_room_for_others(spark):
    rows = [(1, [1.0, 1.0])] + [(2, [9.0, 9.0 + i]) for i in range(30)] + [(3 + i, [1.0, 2.0 + i]) for i in range(5)]
    found = top_k.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("vec_id") == 1, k=4)
    assert [r["vec_id"] for r in found.orderBy("rank").collect()] == [2, 7, 6, 5]


def test_blocks_below_the_kth_score_are_not_visited():
    near = np.eye(4, dtype=np.int64) * 50
    blocks = [(np.arange(4) + 4 * b, near - 40 * b, (near - 40 * b).max(axis=0), (near - 40 * b).min(axis=0)) for b in range(3)]
    ((_, ids, scores, visited),) = top_k.search_cell([(99, np.array([1, 1, 1, 1]), -(10**6))], blocks, 2)
    assert visited == 1 and ids.tolist() == [0, 1] and scores.tolist() == [50, 50]


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<p don't>hello</p><p>it's fine</p><p>end</p>", "hello\n\nit's fine\n\nend"),
        ("<a title=Bob's href=x>link</a> text it's <b>bold</b>", "link text it's bold"),
        ('<p title="a > b" x=\'<i>\'>one<p a=b"c>two', "one\n\ntwo"),
        ("<p a = \"x\"y'>z>q</p>", "z>q"),
        ("<p =x>a</p><p/ /b=c/>d", "a\n\nd"),
        ("a<p title='never closed>b</p>", "a"),
        ("<table><colgroup><col><col><tr><td>a<td>b<tr><td>c<td>d</table>", "a  b\nc  d"),
        ("<table><caption>t<colgroup><col><tbody><tr><td>a<td>b</table>", "t\na  b"),
        ("<details>no <summary>s</summary> no <p>no</details>x", "s\nx"),
        ("<details open><summary>s</summary>yes</details>x", "s\nyes\nx"),
        ("<div style='visibility:hidden'>no <b style='visibility: visible'>yes</b> no</div>", "yes"),
        ("<ul><li>a<li style='visibility:hidden'>no<li style='VISIBILITY:collapse'><i style='visibility:visible'>b</i></ul>", "- a\n- b"),
        ("<p style='visibility:visible'>a<b style='display:none'>no<i style='visibility:visible'>no</i></b>", "a"),
        ("<p hidden=x hidden>no</p><p title=a title='b>'>c", "c"),
    ],
)
def test_tags_as_browsers_cut_them(page, text):
    assert html_text.visible_text(page) == text


def test_pages_are_cut_in_linear_time():
    for page in ("<a " * 100_000 + "'", "<" * 100_000, "<a x='" * 50_000, "<p a=b " * 50_000 + ">", "<!-" * 100_000, "</" * 100_000):
        began = time.perf_counter()
        html_text.visible_text(page)
        assert time.perf_counter() - began < 2


PAGE = """<html><head><title>no</title><style>p{}</style></head><body><h1>A &amp; B</h1><p>one<p>two <b>x</b>
 y<ul><li>a<li>b<ol start=3><li>c<li>d</ol></ul><table><caption>cap<tr><th>n<th>value<tr><td>longer<td>1</table>
<div hidden>no</div><div style="color: red; display:none">no</div><noscript>no</noscript>tail<br>end<script>x<y</script><!-- c -->
<pre>
 a
  b</pre><dl><dt>t<dd>d</dl><img alt="pic"> <input type=hidden value=no></body></html>"""


def test_layout():
    assert html_text.visible_text(PAGE) == "A & B\n\none\n\ntwo x y\n\n- a\n- b\n  3. c\n  4. d\n\ncap\nn       value\nlonger  1\n\ntail\nend\n\n a\n  b\n\nt\n  d\n\npic"


@pytest.mark.parametrize("page", ["</p></div>x", "<a b='<p>'>x", "<p <p>x", "<table><td>x", "<li>x</ul>", "x<!-- open", "<script>x", "&lt;x&gt", "<p>x</span></p>"])
def test_broken_markup_keeps_its_text(page):
    assert ("x" in html_text.visible_text(page)) == ("script" not in page)


@pytest.mark.parametrize("wide", ["w" * 450, "some words " * 40, "y" * 2000])
@pytest.mark.parametrize("rows", [2, 400])
def test_long_tables_with_a_wide_cell_stay_aligned(rows, wide):
    page = "".join(f"<tr><td>a{i}<td>{wide if i == 1 else 'b'}<td>c{i}<br>second{i}<td>{wide}" for i in range(rows))
    lines = html_text.visible_text(f"<table>{page}</table>").split("\n")
    assert len({line.index(f"c{i}") for i in range(rows) for line in lines if re.search(rf"\bc{i}\b", line)}) == 1
    assert {line.index("second") for line in lines if "second" in line} == {line.index("c0") for line in lines if "c0" in line}
    assert "".join(" ".join(lines).split()).count("".join(wide.split())[:11]) >= rows + 1 and max(map(len, lines)) < len(wide) + 3 * html_text.WIDEST


def test_spanning_cells_hold_their_places():
    page = "<table><tr><td rowspan=2>a<td>b<td>c<tr><td>d<td>e<tr><td>f<td rowspan=0>g<td>h<tr><td>i<td>j<tbody><tr><td>k<td>l<td>m</table>"
    assert html_text.visible_text(page) == "a  b  c\n   d  e\nf  g  h\ni     j\nk  l  m"
    many = "".join(f"<td>{i % 10}" for i in range(151))
    first, second = html_text.visible_text(f"<table><tr>{many}<tr><td colspan=150>a<td>z</table>").split("\n")
    assert second.index("z") == len(first) - 1
    assert html_text.visible_text("<table><tr><td colspan=1000000000 rowspan=1000000000>a<td>b<tr><td>c</table>") == "a  b\n   c"


@pytest.mark.parametrize("around", ["<div>", "<span>", "<b><font>", "<blockquote>", "<div><i>", "<table><tr><td>"])
@pytest.mark.parametrize("hides", ["div hidden", "template", "noscript", "svg"])
def test_depth_changes_nothing(around, hides):
    inner = f"<{hides}><div>no<p>no</div>no<b>no</{hides.split()[0]}><table><tr><td>a<td>b<tr><td>long<td>c</table><ol><li>x<li>y</ol>"
    lines = html_text.visible_text(around * 1000 + inner).split("\n")
    assert [x.strip() for x in lines if x.strip()] == ["a     b", "long  c", "1. x", "2. y"]


def test_a_hidden_ancestor_ends_at_its_own_end_tag():
    page = "<div hidden>" + "<div>no" * 1000 + "</div>no" * 1000 + "</div>yes"
    assert html_text.visible_text(page) == "yes"
    assert html_text.visible_text("<ul><li>x" * 1000).split("\n")[-1] == "  " * 999 + "- x"
    assert html_text.visible_text("<div><p>" * 100_000 + "deep") == "deep"


def test_every_operator_has_its_query():
    numbers = sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES)
    assert numbers == list(range(1, 11)) and {n.split("_")[0] for n in queries.ORACLES} == {"op3", "op6", "op9", "op10"}
