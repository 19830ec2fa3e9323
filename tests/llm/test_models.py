"""Learned operators: held-out accuracy and defined results at the edges."""

import numpy as np
from pyspark.sql import functions as F

from tessera.llm import linear, pii, quality, toxicity
from tessera.llm.queries import CATEGORIES

DIR = "/root/testdata/sf0.01"


def _tables(spark, at=DIR):
    return spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")


def test_logistic_regression_finds_the_optimum():
    rng = np.random.default_rng(0)
    lists = [np.flatnonzero(rng.random(20) < 0.3) for _ in range(300)]
    x = linear.Sparse(lists)
    y = (rng.random(300) < linear.sigmoid(x.dot(rng.standard_normal(20)))).astype(float)
    w, d = linear.fit(x, np.zeros((300, 0)), y, 20, rounds=200)
    g = x.pull(linear.sigmoid(x.dot(w) + d[0]) - y, 20) + w
    assert np.abs(g).max() < 1e-2


def test_toxicity_on_held_out_documents(spark):
    docs, labels = _tables(spark, "/root/testdata/sf0.1")  # a few dozen labels don't show most of the words
    train = labels.filter("doc_id % 2 = 0")
    got = toxicity.score(docs, train, CATEGORIES, "toxic").join(labels.filter("doc_id % 2 = 1"), "doc_id").select("rejected", "toxic").collect()
    assert sum(r.rejected == (r.toxic == 1) for r in got) / len(got) > 0.95


def test_toxicity_edges(spark):
    docs, labels = _tables(spark)
    odd = spark.createDataFrame([(None, "idiot", "x"), (1, None, None), (1, "", None)], "doc_id long, text string, p_toxic string")
    rows = toxicity.score(docs.select("doc_id", "text").unionByName(odd.select("doc_id", "text")), labels, CATEGORIES, "toxic")
    assert rows.filter("rejected is null").count() == 0
    none = toxicity.score(odd, labels.filter("false"), CATEGORIES, "toxic").collect()
    assert len(none) == 3 and not any(r.rejected for r in none)
    kept = toxicity.keep(docs, labels, CATEGORIES, "toxic")
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert toxicity.score(odd.filter("false"), labels, CATEGORIES, "toxic").count() == 0
    assert toxicity.score(odd, labels.select("doc_id", F.lit(None).cast("int").alias("quality"), "toxic"), CATEGORIES, "toxic").count() == 3


def test_later_models_see_earlier_probabilities():
    rng = np.random.default_rng(1)
    lists = [np.unique(rng.integers(0, 50, 10)) for _ in range(400)]
    first = np.array([int(3 in x) for x in lists])
    chain = toxicity.Chain(["a", "b"])
    oof = chain.fit(lists, np.column_stack((first, 1 - first)))
    assert chain.models[1][2].shape == (1,) and chain.models[1][2][0] < 0
    assert ((oof[:, 0] > 0.5) == first).mean() > 0.95


def test_quality_on_held_out_documents(spark):
    docs, labels = _tables(spark)
    got = quality.score(docs, labels.filter("doc_id % 2 = 0")).join(labels.filter("doc_id % 2 = 1"), "doc_id").select("kept", "quality").collect()
    assert sum(r.kept == (r.quality == 1) for r in got) / len(got) > 0.9
    views = quality.train(docs, labels, "quality")
    assert sum(views.handed) > 0 and ((views.oof > 0.5) == views.known).mean() > 0.9


def test_quality_edges(spark):
    docs, labels = _tables(spark)
    odd = spark.createDataFrame([(None, None, None, None), (1, "", "s", "en"), (1, "x", None, "en")], "doc_id long, text string, source string, lang string")
    assert [r.p_quality for r in quality.score(odd, labels.filter("false")).collect()] == [1.0] * 3
    assert quality.score(odd.filter("false"), labels).count() == 0
    rows = quality.score(docs.select("doc_id", "text", "source", "lang").unionByName(odd), labels)
    assert rows.filter("p_quality is null or p_quality < 0 or p_quality > 1").count() == 0


def test_base_spans():
    text = "é a.b@c.de, x@y a@b.c@d.e 1.2.3.4 300.1.1.1 1.2.3.4.5 4111 1111-1111 1111 4111111111111112 +1 (988) 555-2485 +12 +1234567890123456"
    got = [(pii.KINDS[k], text[s:e]) for s, e, k in pii.base(text)]
    assert ("email", "a.b@c.de") in got and ("email", "a@b.c") in got and not any(t.startswith("x@y") for _, t in got)
    assert [t for k, t in got if k == "ip"] == ["1.2.3.4", "1.2.3.4"]
    assert [t for k, t in got if k == "phone"] == ["+1 (988) 555-2485"]
    assert pii.base("") == [] and pii.base("1" * 200_000 + "a" * 200_000 + "@") == []


def test_pii_finds_unseen_identifiers(spark):
    rows = [(i, f"text {i} mail to u{i}@mail{i}.org please") for i in range(80)] + [(i, f"text {i} mail to u{i}@local please") for i in range(80, 86)] + [(190, None), (191, ""), (None, "x 9 y"), (192, "other 5@home here")]
    got = {r.doc_id: r for r in pii.find(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kind string")).collect()}
    assert got[3].n_email == 1 and got[3].spans == f"email:15:{len('text 3 mail to u3@mail3.org')}"
    assert got[83].n_email == 0 and got[83].spans.startswith("email:16:") and got[192].spans == ""
    assert got[190].spans == "" and got[191].n_ip == 0 and len(got) == 90
    assert pii.find(spark.createDataFrame([], "doc_id long, text string")).count() == 0
