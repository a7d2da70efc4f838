"""Language ID, toxicity and quality: held-out accuracy and edge rows."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlake.llm import language_id, quality, toxicity
from orderlake.llm.common import held_out

SOUNDS = {"en": ["th", "ing", "er", "on", "he", "at"], "de": ["sch", "ung", "ich", "ein", "ü", "keit"],
          "fr": ["eau", "que", "é", "oi", "les", "ment"]}
INSULTS = {"en": ["moron", "scum"], "de": ["lowei" + x for x in ("nd", "ch", "ro")], "fr": ["vequ" + x for x in "abc"]}


def _text(rng, lang, n):
    return " ".join("".join(rng.choice(SOUNDS[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    """600 texts in three languages, a fifth toxic, a sixth shouted junk."""
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(600):
        lang = rng.choice(list(SOUNDS))
        words = _text(rng, lang, rng.randint(8, 120)).split()
        toxic, poor = int(rng.random() < 0.2), int(rng.random() < 0.17)
        for _ in range(2 * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(INSULTS[lang]))
        text = " ".join(w.upper() + "!!" if poor else w for w in words)
        rows.append((i, text, lang, "score"))
        if i % 5 or i < 100:
            labels.append((i, 1 - poor, toxic))
    odd = [(700, None, None, "a"), (701, "", "en", "a"), (702, "123 !!", "de", "a"), (703, _text(rng, "en", 25000), None, "a"),
           (None, rows[0][1], "en", "a"), (1, rows[1][1], rows[1][2], "a")]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, score string")
    marks = spark.createDataFrame([*labels, labels[0], (None, 1, 1), (5, None, None)],
                                  "doc_id long, quality int, toxic int")
    return docs, marks, {r[0]: r for r in rows}, {r[0]: r for r in labels}, len(rows) + len(odd)


def train():
    return ~held_out(F.col("doc_id"))



def test_language_of_held_out_texts(corpus):
    docs, _, rows, _, n = corpus
    out = language_id.predict_language(docs, train(), result="p", sample=240, landmarks=40)
    assert out.columns == [*docs.columns, "p"]
    got = out.withColumn("out", held_out(F.col("doc_id"))).collect()
    assert len(got) == n and all(0 <= r["p"]["score"] <= 1 for r in got)
    held = [r for r in got if r["out"] and r["doc_id"] in rows]
    assert np.mean([r["p"]["lang"] == rows[r["doc_id"]][2] for r in held]) > 0.97 and len(held) > 100
    by_id = {r["doc_id"]: r["p"] for r in got}
    assert by_id[700]["lang"] == by_id[701]["lang"] == by_id[702]["lang"] == "und" and by_id[700]["score"] == 0
    assert by_id[703]["lang"] == "en"


def test_kernel_equals_direct_ridge_on_all_landmarks():
    """With every row a landmark the folded weights equal kernel ridge."""
    rng = random.Random(1)
    texts = [_text(rng, x, 30) for x in SOUNDS for _ in range(8)]
    labels = [x for x in SOUNDS for _ in range(8)]
    present = np.zeros((len(texts), 1 << 12), dtype=bool)
    for row, t in zip(present, texts, strict=True):
        language_id.mark_presence(t, 12, 3, row)
    grams = [{t.lower()[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)} for t in texts]
    shared = present.astype(int) @ present.T.astype(int)
    assert abs(shared[0, 1] - len(grams[0] & grams[1])) <= 5  # hash collisions only
    m = language_id.fit_ridge(present, labels, 12, 3, landmarks=len(texts), ridge=1e-3)
    kernel = shared / np.sqrt(np.outer(shared.diagonal(), shared.diagonal()))
    y = np.array([[float(a == x) for x in m.languages] for a in labels])
    centred = kernel - kernel.mean(axis=0)
    alpha = np.linalg.lstsq(kernel, centred, rcond=1e-6)[0]
    assert alpha.shape == kernel.shape
    assert (m.scores(present).argmax(axis=1) == y.argmax(axis=1)).all()


def test_nothing_to_learn(spark, corpus):
    docs, marks, *_ = corpus
    one = docs.where("doc_id < 5").withColumn("lang", F.lit(None).cast("string"))
    assert {r["p"]["lang"] for r in language_id.predict_language(one, train(), result="p").collect()} == {"und"}
    none = marks.where("doc_id > 10000")
    assert {r["t"] for r in toxicity.toxicity(one, none, train(), result="t").collect()} == {0.0}
    grades = none.select("doc_id", F.col("quality").alias("grade"))
    assert {r["q"]["tail"] for r in quality.quality(one, grades, train(), result="q").withColumn(
        "q", F.coalesce("q", F.struct(F.lit(None).cast("double").alias("expected_grade"),
                                      F.lit(None).cast("double").alias("tail")))).collect()} == {None}
    empty = docs.limit(0)
    assert language_id.predict_language(empty, train(), result="p").count() == 0
    assert toxicity.toxicity(empty, marks, train(), result="t").count() == 0


def test_toxicity_of_held_out_texts(corpus):
    docs, marks, rows, labels, n = corpus
    out = toxicity.toxicity(docs, marks, train(), result="tox", sample=400, trees=8, depth=3)
    assert out.columns == [*docs.columns, "tox"]
    got = out.withColumn("out", held_out(F.col("doc_id"))).collect()
    assert len(got) == n and all(0 <= r["tox"] <= 1 for r in got)
    held = [(r["tox"] >= 0.3, labels[r["doc_id"]][2]) for r in got if r["out"] and r["doc_id"] in labels]
    toxic = [p for p, y in held if y]
    assert np.mean(toxic) > 0.9 and np.mean([p for p, y in held if not y]) < 0.03 and len(toxic) > 10


def test_toxicity_features():
    lexicon = toxicity.Lexicon({"scum": 2.0, "moron": 3.0, "lowe*": 4.0, "lowei*": 1.0})
    from orderlake.llm.common import WordCache
    f = dict(zip(toxicity.FEATURES, toxicity.features(
        "You are scum! THE m0r0n soooo loweind x".encode(), WordCache(lexicon.code)), strict=True))
    assert f["lexicon_density"] == pytest.approx(9 / 8) and f["lexicon_weight"] == pytest.approx(np.log(10))
    assert (f["strongest"], f["second_strongest"]) == (4.0, 3.0)
    assert f["word_hits"] == f["stem_hits"] == pytest.approx(np.log(2))
    assert f["second_person_near"] == pytest.approx(1 / 8) and f["decoded_lexicon_rate"] == pytest.approx(1 / 8)
    assert f["capital_rate"] == pytest.approx(1 / 8) and f["long_run_rate"] == pytest.approx(1 / 8)
    assert toxicity.features(b" \n ", WordCache(lexicon.code)) == [0.0] * len(toxicity.FEATURES)


def test_ordinal_quality(corpus):
    docs, marks, rows, labels, n = corpus
    grades = marks.select("doc_id", (F.col("quality") * (2 - F.col("toxic"))).alias("grade"))
    out = quality.quality(docs, grades, train(), above=0, result="q", sample=400)
    assert out.columns == [*docs.columns, "q"]
    got = out.withColumn("out", held_out(F.col("doc_id"))).collect()
    assert len(got) == n
    assert all(0 <= r["q"]["tail"] <= 1 and 0 <= r["q"]["expected_grade"] <= 2 for r in got)
    held = [(r["q"]["tail"] >= 0.5, labels[r["doc_id"]][1]) for r in got if r["out"] and r["doc_id"] in labels]
    assert np.mean([p == bool(y) for p, y in held]) > 0.95


def test_thresholds_stay_ordered_and_recover_grades():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, 5)).astype(np.float32)
    z = x @ np.array([2.0, -1.0, 0.5, 0.0, 0.0]) + rng.logistic(size=900)
    grade = np.array([0, 3, 4, 9])[np.searchsorted([-2.0, 0.0, 2.5], z)]
    m = quality.fit_thresholds(x, grade, [0, 3, 4, 9], bits=3, rate=0.05)
    assert (np.diff(m.thresholds) > 0).all()
    np.testing.assert_allclose(m.thresholds, [-2.0, 0.0, 2.5], atol=0.5)
    np.testing.assert_allclose(m.weights[:3], [2.0, -1.0, 0.5], atol=0.4)


def _fitted_on(monkeypatch, docs, **params):
    """(labels, presence rows) that the language model is fitted on."""
    seen = []
    fit_ridge = language_id.fit_ridge

    def spy(present, labels, *a):
        seen.append((labels, present))
        return fit_ridge(present, labels, *a)
    monkeypatch.setattr(language_id, "fit_ridge", spy)
    language_id.fit(docs, "text", "lang", F.lit(True), **params)
    return seen[0]


def test_language_sample_holds_copies_once(spark, monkeypatch):
    """300 copies of the text with the least draw take one place of the sample."""
    rng = random.Random(11)
    rows = [(_text(rng, lang, 12), lang) for lang in ("en", "de") for _ in range(300)]
    docs = spark.createDataFrame(rows, "text string, lang string")
    least = docs.orderBy(F.shiftrightunsigned(F.xxhash64("text", F.lit(7)), 11)).first()
    copies = spark.createDataFrame([tuple(least)] * 300, docs.schema)
    labels, present = _fitted_on(monkeypatch, docs.union(copies), sample=40, landmarks=10)
    assert sorted(labels) == ["de"] * 20 + ["en"] * 20
    assert len(np.unique(present, axis=0)) == 40


def test_every_language_is_learned(spark, monkeypatch):
    """Also rare languages beside frequent ones, and more languages than ``sample``."""
    rng = random.Random(12)
    names = [f"l{i}" for i in range(7)]
    rows = [(_text(rng, "en", 8), x) for x in names for _ in range(200 if x < "l2" else 2)]
    labels, _ = _fitted_on(monkeypatch, spark.createDataFrame(rows, "text string, lang string"), sample=4, landmarks=4)
    assert sorted(labels) == names


def test_shared_passage_is_no_near_copy(spark):
    """Texts with one long passage in common all count, near copies of a label once."""
    rng = random.Random(13)
    passage = _text(rng, "en", 60)
    rows = [(i % 2, f"{_text(rng, 'en', 40)} {passage} {_text(rng, 'en', 40)} own{'abcdefghijkl'[i]}") for i in range(12)]
    copies = [(0, rows[0][1] + " tail"), (0, rows[0][1]), (1, rows[0][1])]
    train = spark.createDataFrame(rows + copies, "label int, text string")
    got = [(r["label"], [t for t in r["terms"] if t.startswith("own") and len(t) == 4 and "*" not in t])
           for r in toxicity.without_near_copies(train).collect()]
    assert sorted(got) == sorted([(i % 2, ["own" + "abcdefghijkl"[i]]) for i in range(12)] + [(1, ["owna"])])


def test_toxicity_sample_is_bounded_whatever_repeats(spark, monkeypatch):
    """One id with very many texts, one text with very many ids: at most
    ``sample`` texts, each once, and a text with both labels is toxic."""
    rng = random.Random(12)
    rows = [(1, _text(rng, "en", 20)) for _ in range(400)] + [(i, "all the same toxic text moron") for i in range(2000, 2300)]
    rows += [(i, _text(rng, "de", 20) + " scum" * (i % 2)) for i in range(3000, 3200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    marks = spark.createDataFrame([(i, int(i % 2)) for i in {r[0] for r in rows}], "doc_id long, toxic int")
    seen, written = {}, toxicity.written

    def kept(df, name):
        seen[name] = written(df, name)
        return seen[name]
    monkeypatch.setattr(toxicity, "written", kept)
    toxicity.fit(docs, marks, F.lit(True), "doc_id", "text", "toxic", sample=60, trees=2, depth=2)
    sample = seen["toxicity-sample"].collect()
    assert len(sample) == 60 == len({r["text"] for r in sample}) and sum(r["label"] for r in sample) == 30
    texts = {r["h"]: r["label"] for r in seen["toxicity-ids"].collect()}
    assert len(texts) == 601 and sum(texts.values()) == 400 + 1 + 100
    first = sorted(r["h"] for r in sample)
    toxicity.fit(docs.repartition(7), marks, F.lit(True), "doc_id", "text", "toxic", sample=60, trees=2, depth=2)
    assert sorted(r["h"] for r in seen["toxicity-sample"].collect()) == first


def test_lexicon_equals_a_plain_count(spark):
    import math
    rng = random.Random(13)
    rows = [(1, _text(rng, "en", 30) + " moron stays") for _ in range(40)] + [(0, _text(rng, "en", 30) + " stays") for _ in range(160)]
    rows += [(1, _text(rng, "fr", 30) + " vequa") for _ in range(12)] + [(0, "moron " + _text(rng, "fr", 30))]
    train = spark.createDataFrame(rows, "label int, text string").repartition(3)
    n = {0: 161, 1: 52}
    seen = {}
    for label, text in rows:
        words = set(toxicity._LETTERS.findall(text.lower()))
        for term in words | {f"{w[:k]}*" for w in words for k in toxicity.STEMS if len(w) >= k}:
            seen.setdefault(term, [0, 0])[label] += 1
    want = {}
    for term, (c, t) in seen.items():
        part = n[1] / (n[0] + n[1])
        g = 2 * ((t * math.log(t / ((t + c) * part)) if t else 0) + (c * math.log(c / ((t + c) * (1 - part))) if c else 0))
        if t >= max(4, 0.01 * n[1]) and t / n[1] >= 6 * (c + 0.5) / n[0] and g >= 16:
            want[term] = math.log((t + 0.5) / (n[1] + 1)) - math.log((c + 0.5) / (n[0] + 1))
    got = toxicity.learn_lexicon(train).weights
    assert got == pytest.approx(want) and {"moron", "moro*", "vequa"} <= set(got) and "stays" not in got


def test_quality_gradient_equals_finite_differences():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(60, 4)).astype(np.float32)
    y, k, d, l2 = rng.integers(0, 4, 60), 4, 4, 0.01
    theta = np.concatenate((rng.normal(size=d), [-1.0], np.log([0.7, 1.3])))

    def loss(th):
        cuts = [th[d]]
        for gap in th[d + 1:]:
            cuts.append(cuts[-1] + np.exp(gap))
        total = 0.0
        for row, grade in zip(x.astype(float), y.tolist(), strict=True):
            z = sum(a * b for a, b in zip(row, th[:d], strict=True))
            above = [1.0, *(1 / (1 + np.exp(c - z)) for c in cuts), 0.0]
            total -= np.log(above[grade] - above[grade + 1])
        return total / len(y) + l2 / 2 * sum(w * w for w in th[:d])

    step = 1e-5 * np.eye(len(theta))
    want = [(loss(theta + e) - loss(theta - e)) / 2e-5 for e in step]
    np.testing.assert_allclose(quality.gradient(theta, x, y, k, l2), want, atol=2e-5)


def test_quality_sample_is_bounded_whatever_repeats(spark, monkeypatch):
    """One id with very many texts, one text with very many ids."""
    rng = random.Random(14)
    rows = [(1, _text(rng, "en", 20)) for _ in range(400)] + [(i, "all the same text") for i in range(2000, 2300)]
    rows += [(i, _text(rng, "de", 20)) for i in range(3000, 3200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    grades = spark.createDataFrame([(i, i % 3) for i in {r[0] for r in rows}], "doc_id long, grade int")
    seen, real = [], quality.fit_thresholds

    def spy(x, grade, *a, **k):
        seen.append((x.tobytes(), grade.tolist()))
        return real(x, grade, *a, steps=2, **k)
    monkeypatch.setattr(quality, "fit_thresholds", spy)
    kept, written = {}, quality.written
    monkeypatch.setattr(quality, "written", lambda df, name: kept.setdefault(f"{name}{len(seen)}", written(df, name)))
    for parts in (4, 7):
        quality.fit(docs.repartition(parts), grades, F.lit(True), "doc_id", "text", "grade", sample=60)
    assert len(seen[0][1]) == 60 and seen[0] == seen[1]
    texts = {r["h"]: r["grade"] for r in kept["quality-texts0"].collect()}
    assert len(texts) == 601 and texts[spark.sql("SELECT xxhash64('all the same text')").first()[0]] == 0
    least = sorted((r["draw"], r["h"]) for r in kept["quality-sample0"].collect())
    assert len({h for _, h in least}) == 60
