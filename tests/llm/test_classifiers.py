"""Language, toxicity and quality models: accuracy on held-out documents,
hard cases, and agreement of the two ways that scores are computed."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stridelake.llm import langid, ordinal, toxicity
from stridelake.llm.common import sampled_texts
from stridelake.llm.common import crc_mod, crc_mod_column, documents, labels, sample_rows
from tests.llm.fixtures import documents_frame

SF = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def rated(spark):
    return documents(spark, SF), labels(spark, SF)


def learn(column):
    return crc_mod_column(column, 4) != 2


def test_fold_matches_python(spark):
    ids = spark.createDataFrame([(i,) for i in [None, *range(-5, 40), 2**62]], "doc_id long")
    for r in ids.select("doc_id", crc_mod_column(F.col("doc_id"), 4).alias("m")).collect():
        assert r["m"] == crc_mod(r["doc_id"], 4)


def test_samples_are_bounded(spark):
    rows = spark.range(20000).select((F.col("id") % 2).alias("c"), "id")
    found = sample_rows(rows, "c", 100, 5, 1).groupBy("c").count().collect()
    assert len(found) == 2 and all(50 < r["count"] < 160 for r in found)


# --- language ----------------------------------------------------------------

@pytest.mark.parametrize("n", [1, 2, 4, 9, 30])
def test_codewords_differ(n):
    code = langid.codewords(n)
    assert len({tuple(r) for r in code.tolist()}) == n
    if n > 6:
        assert min((a != b).sum() for i, a in enumerate(code) for b in code[:i]) >= code.shape[1] // 4


def test_language_of_held_out_documents(spark):
    docs = documents(spark, SMALL)
    model = langid.train(docs, learn(docs["doc_id"]), per_language=120)
    got = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 150 and np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.97
    hard = documents_frame(spark)
    rows = langid.identify(hard, model).collect()
    assert len(rows) == hard.count() and all(0 <= r["score"] <= 1 for r in rows)
    letters = {r["doc_id"]: any(map(str.isalpha, r["text"] or "")) for r in hard.where("doc_id <> 4").collect()}
    for r in rows:
        if r["doc_id"] in letters:
            assert (r["lang_pred"] == "und") == (not letters[r["doc_id"]])
            assert r["held_out"] == (crc_mod(r["doc_id"], 4) == 2)
    kept = langid.with_known_language(hard, model)
    assert kept.columns == hard.columns
    clear = [r for r in langid.identify(hard, model, ambiguity=0.8).collect() if r["lang_pred"] != "und" and not r["ambiguous"]]
    assert kept.count() == len(clear)


def test_more_languages_than_the_model_may_have(spark):
    rows = [(i, f"word{i % 7} text", f"l{i % 7}") for i in range(28)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="max_languages"):
        langid.train(docs, F.lit(True), max_languages=6)
    assert len(langid.train(docs, F.lit(True), max_languages=7).langs) == 7


def test_language_without_labels(spark):
    hard = documents_frame(spark)
    model = langid.train(hard, F.lit(False))
    assert model is None
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(hard, model).collect()} == {("und", 0.0)}
    one = langid.train(hard.where("lang = 'en'"), F.lit(True))
    assert {r["lang_pred"] for r in langid.identify(hard, one).collect()} == {"en", "und"}
    assert langid.identify(hard.limit(0), one).count() == 0 and langid.with_known_language(hard.limit(0), one).count() == 0


# --- toxicity ----------------------------------------------------------------

def brute_kernel(a, b):
    from itertools import combinations

    def features(w):
        w = "^" + w
        out = {}
        for at in combinations(range(len(w)), toxicity.LENGTH):
            stretch = at[-1] - at[0] + 1
            if stretch <= toxicity.SPAN:
                u = "".join(w[i] for i in at)
                out[u] = out.get(u, 0) + toxicity.DECAY ** stretch
        return out
    x, y = features(a), features(b)
    dot = lambda p, q: sum(v * q.get(u, 0) for u, v in p.items())
    return dot(x, y) / max(1e-12, (dot(x, x) * dot(y, y)) ** 0.5)


def test_kernel_against_brute_force():
    words = ["banana", "bandana", "panama", "abc", "aaaaaaa", "abcabcabc", "zebra"]
    owner, code, value = toxicity.kernel_rows([w.encode() for w in words])
    vectors = [dict(zip(code[owner == i].tolist(), value[owner == i])) for i in range(len(words))]
    size = toxicity.norms(owner, value, len(words))
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            got = sum(v * vectors[j].get(u, 0) for u, v in vectors[i].items()) / max(1e-12, size[i] * size[j])
            assert got == pytest.approx(brute_kernel(a, b))


def test_toxicity_of_held_out_documents(spark, rated):
    docs, marks = rated
    model = toxicity.train(docs, marks, learn(marks["doc_id"]), max_toxic=600, max_clean=900)
    got = toxicity.score_toxicity(docs, model).join(marks, "doc_id").where("held_out").collect()
    label = np.array([r["toxic"] for r in got])
    flagged = np.array([r["predicted"] for r in got])
    assert flagged[label == 1].mean() > 0.8 and flagged[label == 0].mean() < 0.05
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in got)

    exact = model.score_words([b"idiot", b"moron"])
    assert exact > 0.3 and model.score_words([b"idiot"]) > 0.3
    for evasive in ([b"id.iot", b"moron"], [b"i-d-i-o-t", b"m0ron"], [b"1diot!!", b"moron"]):
        assert model.score_words(evasive) == pytest.approx(exact)
    assert model.score_words(toxicity.document_words("an i d i o t and a moron")) >= exact
    assert model.score_words([b"idioot", b"moroon"]) > 10 * model.score_words([b"idea", b"motion"])

    hard = documents_frame(spark)
    rows = toxicity.score_toxicity(hard, model).collect()
    assert len(rows) == hard.count() and all(0 <= r["score"] <= 1 for r in rows)


def test_repeated_insults_leave_room_for_others():
    import pyarrow as pa

    insults = [b"idiot", b"moron", b"wretch"]
    owner, code, value = toxicity.kernel_rows(insults)
    codes, at = np.unique(code, return_inverse=True)
    gains = np.bincount(at, weights=value * np.array([3.0, 2.0, 1.0])[owner])
    model = toxicity.Model(codes, gains, -1.0, np.array([1.0, 1.0, 1.0, -1.0]))
    texts = ["idiot " * n + "moron and wretch " + "plain words " * 50 for n in (1, 40, 400)]
    batch = pa.record_batch([pa.array(range(3)), pa.array(texts)], ["doc_id", "text"])
    got = next(toxicity.scorer(model, 0.3, 10**6, 4)([batch])).column("score").to_pylist()
    assert got == pytest.approx([model.score_words(toxicity.document_words(texts[0]))] * 3)


def test_toxicity_without_labels(spark):
    hard = documents_frame(spark)
    marks = spark.createDataFrame([(1, None), (4, 0), (None, 1), (4, 0)], "doc_id long, toxic int")
    model = toxicity.train(hard, marks, F.lit(True))
    assert model is None
    assert {(r["score"], r["predicted"]) for r in toxicity.score_toxicity(hard, model).collect()} == {(0.0, 0)}
    assert toxicity.score_toxicity(hard.limit(0), model).count() == 0


# --- quality -----------------------------------------------------------------

def test_quality_of_held_out_documents(spark, rated):
    docs, marks = rated
    ratings = ordinal.grades_of(marks)
    model = ordinal.train(docs, ratings, learn(ratings["doc_id"]), per_grade=400)
    assert (np.diff(model.thresholds) >= 0).all()
    got = ordinal.grade_documents(docs, model).join(ratings, "doc_id").where("held_out").collect()
    grade = np.array([r["grade"] for r in got])
    kept = np.array([r["kept"] for r in got])
    assert kept[grade == 2].mean() > 0.97 and kept[grade == 0].mean() < 0.1
    expected = np.array([r["expected_grade"] for r in got])
    assert expected[grade == 0].mean() < expected[grade == 1].mean() < expected[grade == 2].mean()
    assert all((r["score"] >= 0.5) == r["kept"] and 0 <= r["expected_grade"] <= 2 for r in got)
    hard = documents_frame(spark)
    assert ordinal.grade_documents(hard, model).count() == hard.count()


def test_quality_scores_agree_with_the_feature_rows():
    texts = ["Some Words here", "SHOUT!! SHOUT!!", "", "a | b | c", "x x x x x x"]
    model = ordinal.train_model(texts * 3, [2, 0, 1, 0, 0] * 3)
    import pyarrow as pa

    batch = pa.record_batch([pa.array(range(5)), pa.array(texts)], ["doc_id", "text"])
    got = next(ordinal.scorer(model, 1, 0.5, 10**6, 4)([batch])).to_pylist()
    words, sequences = ordinal.Vocabulary(), []
    for t in texts:
        sequences.append(ordinal.word_ids(words, t.encode().split()))
    tails = model.tails(ordinal.feature_rows(list(words), sequences) @ model.weights)
    assert [r["score"] for r in got] == pytest.approx(tails[:, 0].tolist(), rel=1e-4)
    assert [r["expected_grade"] for r in got] == pytest.approx(tails.sum(axis=1).tolist(), rel=1e-4)


def test_quality_gradient_reaches_the_optimum():
    rng = np.random.default_rng(0)
    x = np.zeros((300, ordinal.WIDTH), np.float32)
    x[:, 0] = rng.random(300)
    grade = np.searchsorted([0.3, 0.7], x[:, 0] + rng.normal(0, 0.05, 300))
    model = ordinal.fit(x, grade, decay=0.0, steps=2000)
    right = (model.expected(model.tails(x @ model.weights)).round() == grade).mean()
    assert right > 0.85


def test_quality_with_one_grade_or_none(spark):
    hard = documents_frame(spark)
    only = spark.createDataFrame([(4, 2), (7, 2)], "doc_id long, grade int")
    rows = ordinal.grade_documents(hard, ordinal.train(hard, only, F.lit(True))).collect()
    assert {(r["expected_grade"], r["kept"]) for r in rows} == {(2.0, True)}
    none = ordinal.train(hard, only.limit(0), F.lit(True))
    assert none is None and ordinal.grade_documents(hard.limit(0), none).count() == 0
    marks = spark.createDataFrame([(1, 1, None), (1, 0, 1), (2, None, 1), (3, 1, 1), (5, 1, 0)], "doc_id long, quality int, toxic int")
    assert sorted(tuple(r) for r in ordinal.grades_of(marks).collect()) == [(1, 0), (3, 1), (5, 2)]


def test_repeated_ids_bring_one_text_each(spark):
    docs = spark.createDataFrame([(i % 3, f"text {i % 3}", "x") for i in range(600)] + [(None, "n", "x"), (2, None, "x")],
                                 "doc_id long, text string, grade string")
    picked = spark.createDataFrame([(0, 1), (0, 2), (1, 1), (2, 0), (9, 1)], "doc_id long, grade int")
    got = sorted(tuple(r) for r in sampled_texts(docs, picked).collect())
    assert got == [(0, 1, "text 0"), (0, 2, "text 0"), (1, 1, "text 1"), (2, 0, "")]
    assert sampled_texts(docs.limit(0), picked).count() == 0
