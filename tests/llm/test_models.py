"""Quality scores and languages: held-out accuracy, defined results for odd input."""

import zlib

import numpy as np
import pytest

from roadbook.llm import langid, quality, queries


def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.queries()["op3_quality"](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    known = [r for r in rows if r.held_out and r.doc_id in labels]
    assert np.mean([r.predicted == labels[r.doc_id] for r in known]) > 0.95


def test_quality_of_odd_input(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {(r.score, r.predicted) for r in quality.classify(odd_docs, none).collect()} == {(0.5, 1)}
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 0), (8, None), (None, 1), (7, 1)], "doc_id long, quality int")
    rows = quality.classify(odd_docs.selectExpr("*", "'x' AS stats", "1 AS label", "2 AS fold"), labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out for r in rows if r.id is None)
    assert len({r.score for r in rows if r.id == 5}) == 1
    assert quality.classify(no_docs, labels).count() == 0


def test_isotonic():
    found = quality.isotonic(np.array([1.0, 0.0, 2.0, 2.0, 1.0]), np.array([1.0, 3.0, 1.0, 1.0, 2.0]))
    assert np.allclose(found, [0.25, 0.25, 1.5, 1.5, 1.5])
    assert len(quality.isotonic(np.zeros(0), np.zeros(0))) == 0


def test_normal_equations_are_those_of_all_rows(spark):
    chance = np.random.default_rng(0)
    stats = chance.normal(size=(60, len(quality.STATISTICS)))
    label = (stats[:, 0] > 0).astype(float)
    rows = spark.createDataFrame(
        [(s.tolist(), k % 2, float(y)) for k, (s, y) in enumerate(zip(stats, label, strict=True))], "stats array<double>, fold int, label double"
    ).repartition(5)
    mean, scale = quality._moments(rows)
    assert np.allclose(mean, stats.mean(axis=0)) and np.allclose(scale, stats.std(axis=0))
    model = quality.Model(mean, scale, *[np.zeros(1)] * 4)
    matrices, targets = quality._normal_sums(rows, model)
    z = model.features(stats)
    assert np.allclose(matrices.sum(axis=0), z.T @ z) and np.allclose(targets.sum(axis=0), z.T @ label)
    assert np.allclose(matrices[0], z[::2].T @ z[::2])


def test_language_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = queries.queries()["op6_language"](spark, folder).collect()
    assert len(rows) == len(lang)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]) > 0.99
    assert np.mean([r.rejected for r in rows]) < 0.002


@pytest.fixture(scope="module")
def model(make_docs):
    words = {"en": "the and of that with from", "de": "der und das mit von nicht"}
    return langid.fit(make_docs([(i, " ".join(w for w in words[k].split() for _ in range(1 + i % 3)), k) for i in range(60) for k in words]))


def test_language_of_odd_input(model, odd_docs, make_docs, no_docs):
    rows = {(r.doc_id, r.lang_pred, r.rejected) for r in langid.identify(odd_docs, model).collect()}
    assert {(1, "und", True), (2, "und", True), (3, "und", True), (8, "und", True)} <= rows
    assert model.languages == ["de", "en"]
    clash = make_docs([(1, "der und das", "de"), (2, "дом и мир", "ru")], "lang_pred score rejected")
    found = {r.doc_id: r for r in langid.identify(clash, model).collect()}
    assert found[1].lang_pred == "de" and not found[1].rejected and 0 < found[1].score <= 1
    assert found[2].rejected
    kept = langid.drop_rejected(clash, model)
    assert kept.columns == clash.columns and [r.doc_id for r in kept.collect()] == [1]
    assert langid.identify(no_docs, model).count() == 0


def test_language_without_learnable_rows(no_docs, odd_docs):
    model = langid.fit(no_docs)
    assert {(r.lang_pred, r.score, r.rejected) for r in langid.identify(odd_docs, model).collect()} == {("und", 0.0, True)}


def test_counts_do_not_depend_on_neighbours():
    texts = ["abc", None, "", "x", "café İ au lait", "  abc  ", "日"]
    together, found = langid.counts(texts)
    for k, text in enumerate(texts):
        alone, own = langid.counts([text])
        assert (alone[0] == together[k]).all() and own[0] == found[k]
    assert found.tolist() == [True, False, False, True, True, True, True]


@pytest.mark.parametrize("slots", [1, 3, 16])
def test_sample_is_that_of_one_ranking(spark, monkeypatch, slots):
    rows = spark.range(4000).selectExpr("if(id % 3 = 0, 'xx', 'yy') as lang", "concat('text ', id % 1500) as text").repartition(7)
    monkeypatch.setattr(langid, "SLOTS", slots)
    found = {(r["lang"], r["hash"]) for r in langid._sample(rows).collect()}
    every = rows.selectExpr("lang", "xxhash64(text) as hash").distinct().collect()
    wanted = {(lang, h) for lang in ("xx", "yy") for h in sorted(r["hash"] for r in every if r["lang"] == lang)[: langid.SAMPLE]}
    assert found == wanted


def test_copies_do_not_thin_the_sample(spark, monkeypatch, make_docs):
    monkeypatch.setattr(langid, "SAMPLE", 5)
    texts = [f"wort nummer {'abcdefghij'[k]} und noch eins" for k in range(10)]
    docs = make_docs([(i, texts[i % 10], "de") for i in range(2000)] + [(i, "the one text of it", "en") for i in range(2000, 5000)])
    rows = docs.select("lang", "text")
    assert {r.lang: r["count"] for r in langid._sample(rows).groupBy("lang").count().collect()} == {"de": 5, "en": 1}
    assert langid.fit(docs).languages == ["de", "en"]


@pytest.fixture(scope="module")
def table_model(spark):
    return langid.fit(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


@pytest.mark.parametrize("repeat", [1, 4, 100])
def test_unlearned_languages_are_rejected(table_model, repeat):
    texts = [
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem. ",
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto. ",
        "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью. ",
        "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα. ",
    ]
    assert table_model.predict([t * repeat for t in texts])[2].all()


@pytest.mark.parametrize("size", [100, 1000, 20_000])
def test_random_letters_are_rejected(table_model, size):
    chance = np.random.default_rng(size)
    for first, number in ((0x61, 26), (0x430, 32), (0x4E00, 20_000)):
        text = "".join(chr(first + k) if k >= 0 else " " for k in chance.integers(-number // 6, number, size))
        assert table_model.predict([text])[2].all()


def test_short_texts_of_a_language_stay(spark, table_model):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("n_chars > 200 and text not like '%@%'").limit(300).collect()
    for size in (40, 100, 200):
        assert np.mean(table_model.predict([r.text[:size] for r in rows])[2]) < 0.01
