import zlib

import numpy as np
from pyspark.sql import functions as F

from tallyforge.llm import language, quality, trees

SF = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs.where(~language.held_out("doc_id")))
    got = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(language.held_out("doc_id")).collect()
    assert len(got) == sum(zlib.crc32(str(i).encode()) % 4 == 2 for i in range(1000))
    assert sum(r.lang == r.lang_pred for r in got) >= 0.99 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_language_hard_rows(spark, hard, empty):
    model = language.train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    got = language.identify(hard, model).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == hard.count()
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3, 9))
    assert by[4].lang_pred == "en" and by[7].lang_pred == "de" and by[11].lang_pred in model.languages
    assert language.identify(empty, model).count() == 0
    nothing = language.train(empty)
    assert {r.lang_pred for r in language.identify(hard, nothing).collect()} == {"und"}
    kept = language.identified(hard, model)
    assert kept.columns == hard.columns and {r.doc_id for r in kept.collect()} == {4, 5, 6, 7, 8, 10, 11, 12, None}


def test_mixture_finds_both_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs)
    text = {lang: "\n".join(r.text for r in docs.where(f"lang = '{lang}'").orderBy("doc_id").limit(8).collect())[:6000] for lang in ("en", "de")}
    share, _ = language.mixtures(model, [(text["en"] + text["de"]).encode(), text["en"].encode()])
    names = list(model.languages)
    assert 0.35 < share[0][names.index("de")] < 0.65 and 0.35 < share[0][names.index("en")] < 0.65
    assert share[1].argmax() == names.index("en") and share[1].max() > 0.9


def test_mixture_finds_four_languages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs)
    assert len(model.languages) >= 4
    four = model.languages[:4]
    text = {lang: "\n".join(r.text for r in docs.where(f"lang = '{lang}'").orderBy("doc_id").limit(8).collect())[:6000] for lang in four}
    share, _ = language.mixtures(model, ["\n".join(text.values()).encode(), text[four[0]].encode()])
    assert {model.languages[k] for k in np.flatnonzero(share[0])} == set(four) and all(0.15 < s < 0.35 for s in share[0][:4])
    assert share[1].max() > 0.9 and abs(share[0].sum() - 1) < 1e-3


def test_pieces_have_the_trigrams_of_the_whole():
    texts = [b"one two three four " * 30, b"", b"x" * 90, "é ü ß ÀÉÎ".encode() * 9, b"last", "日本語ÜBER".encode() * 40, b" ", b"ab"]

    def counted(most):
        out = np.zeros((len(texts), 512), int)
        for of, group, context in language.pieces(texts, most):
            codes, owner = language.trigrams(group, 512, context)
            np.add.at(out, (of[owner], codes), 1)
        return out

    whole = counted(1 << 20)
    for most in (1, 2, 3, 7, 40, 100):
        assert (counted(most) == whole).all()


def test_numerals_are_no_letters(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(docs)
    rows = spark.createDataFrame([(1, "½ ² ½"), (2, "① Ⅷ"), (3, "½ a"), (4, "Ⅷ ª"), (5, "é")], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in language.identify(rows, model).collect()}
    assert got[1] == got[2] == "und" and "und" not in (got[3], got[4], got[5])


def test_rows_do_not_depend_on_their_neighbours(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    model = language.train(docs)
    texts = [(r.text or "").encode() for r in docs.collect()]
    together, _ = language.mixtures(model, texts)
    for k in range(0, len(texts), 17):
        alone, _ = language.mixtures(model, [texts[k]])
        assert np.allclose(alone[0], together[k], atol=1e-3)


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = quality.scored(docs, labels).join(labels, "doc_id").where("held_out").select("quality", "score", "predicted").collect()
    y, s = np.array([r.quality for r in got]), np.array([r.score for r in got])
    order = np.argsort(s)
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    auc = (rank[y == 1].mean() - rank[y == 0].mean()) / len(s) + 0.5
    assert auc > 0.9
    assert np.mean([r.predicted == r.quality for r in got]) > 0.95


def test_quality_hard_rows(spark, hard, empty):
    labels = spark.createDataFrame([(4, 1, 0), (7, 1, 0), (8, 0, 0), (9, 0, 0), (10, 0, 0), (99, 1, 1), (None, 0, 0), (5, None, 0)], "doc_id long, quality int, toxic int").selectExpr("*", "1 AS score", "2 AS log_chars")
    got = quality.scored(hard, labels).collect()
    assert len(got) == hard.count() and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    none = quality.scored(hard, labels.where("false")).collect()
    assert {r.score for r in none} == {0.5}
    assert quality.scored(empty, labels).count() == 0
    assert {r.held_out for r in got if r.doc_id is None} == {False}


def test_compiled_rules_score_as_the_arrays_do(spark):
    x = np.random.default_rng(1).random((400, len(quality.FEATURES)))
    y = ((x[:, 1] > 0.5) ^ (x[:, 4] < 0.3)).astype(int)
    model = quality.fit(x, y)
    assert ((model.score(x) > 0.5) == y).mean() > 0.95
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], ", ".join(f"{n} double" for n in quality.FEATURES))
    got = [r[0] for r in df.select(model.column()).collect()]
    assert np.allclose(got, model.score(x))


def test_lasso_drops_useless_rules():
    draw = np.random.default_rng(2)
    r = draw.integers(0, 2, (500, 20)).astype(float)
    y = (r[:, 3] > 0).astype(float)
    w, _ = quality.lasso_logistic(r, y, 0.02)
    assert w[3] > 1 and np.abs(np.delete(w, 3)).max() < 0.05


def test_trees_split_where_it_helps():
    x = np.array([[0.0], [1.0], [2.0], [3.0]])
    t = trees.grow(x, np.array([0.0, 0, 1, 1]), np.ones(4), trees.cut_points(x), 2, 1)
    assert (t.threshold, t.left, t.right) == (1.5, 0.0, 1.0)


def test_statistics_of_empty_text(spark):
    s = quality.statistics(F.lit(None).cast("string"))
    assert all(v is not None and abs(v) < 2 for v in spark.range(1).select(*(c.cast("double").alias(k) for k, c in s.items())).first())
