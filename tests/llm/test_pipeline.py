"""The classifier on held-out labels, and the pipeline's stages."""

import importlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from hirelake.llm.cotraining import co_train, fit_logistic, keep_good, score_documents, train_quality
from hirelake.llm.parity import jaccard_components


def test_logistic_regression():
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(2000, 5))
    y = (x @ [2, -1, 0, 0, 1] + rnd.normal(size=2000) * 0.3 > 0).astype(float)
    model = fit_logistic(x[:1000], y[:1000])
    assert ((model.logit(x[1000:]) > 0) == y[1000:]).mean() > 0.9


def test_views_teach_each_other():
    """With few labels the pool helps; one class alone gives no model."""
    rnd = np.random.default_rng(2)
    y = rnd.integers(0, 2, 3000)
    a = rnd.normal(size=(3000, 30)) + y[:, None] * 0.5
    b = rnd.normal(size=(3000, 30)) + y[:, None] * 0.5
    label = np.where(np.arange(3000) < 60, y, -1)
    model = co_train(a[:2000], b[:2000], label[:2000])
    assert ((model.score(a[2000:], b[2000:]) > 0.5) == y[2000:]).mean() > 0.9
    assert co_train(a[:100], b[:100], np.ones(100, int)) is None


def test_held_out_accuracy(spark, given):
    docs, _ = given("documents", "sf0.1")
    labels, rows = given("labels", "sf0.1")
    model = train_quality(docs, labels.where("doc_id % 2 = 0"))
    truth = {r[0]: r[1] for r in rows if r[0] % 2}
    got = {r.doc_id: r.quality for r in score_documents(docs, model).collect() if r.doc_id in truth}
    good = [got[i] for i, q in truth.items() if q == 1]
    bad = [got[i] for i, q in truth.items() if q == 0]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.2


def test_a_rare_class_is_drawn_whole(spark, documents, monkeypatch):
    """Three bad labels in a table ten times the bound; every unlabelled document is
    looked at."""
    import hirelake.llm.cotraining as c

    bad = {500, 1001, 1502}
    texts = ["BUY!!! $$$ 999 " * 9 if i in bad or i >= 2900 else f"a quiet line of plain words number {i} " * 5 for i in range(3000)]
    docs = documents(texts)
    labels = spark.createDataFrame([(i, int(i not in bad)) for i in range(2000)], "doc_id long, quality int")
    seen = []
    fit = c.co_train
    monkeypatch.setattr(c, "co_train", lambda x, m, y, **o: seen.append(y) or fit(x, m, y, **o))
    model = train_quality(docs, labels, labelled=200)
    assert (seen[0] == 0).sum() == 3 and (seen[0] == 1).sum() == 197
    got = {r.doc_id: r.quality for r in score_documents(docs, model).collect()}
    assert not any(got[i] for i in range(2900, 3000)) and all(got[i] for i in range(2900) if i not in bad)
    judges = [c.Judge(m, c.Logistic(np.zeros(1), np.ones(1), np.ones(1), 0.0)) for m in (model.content, model.metadata)]
    given = c._offers_of_table(docs, labels, 9)(judges, 0.0, 5000)
    assert {k: len(x) for k, x in given.items()} == dict.fromkeys([(0, 1), (0, 0), (1, 1), (1, 0)], 1000)


def test_one_label_of_a_class_is_enough():
    label = np.array([0] + [1] * 40)
    x = np.random.default_rng(3).normal(size=(41, 4)) + label[:, None]
    assert co_train(x, x, label) is not None


def test_awkward_documents(spark, documents, awkward):
    docs = documents(awkward, [None, *range(1, len(awkward))], [None] * len(awkward))
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(1, 13)] * 2 + [(3, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int"
    )
    model = train_quality(docs, labels)
    scored = score_documents(docs, model).collect()
    assert len(scored) == len(awkward) and all(0 <= r.score <= 1 for r in scored)
    assert keep_good(docs, None).count() == len(awkward)  # without a model all is kept
    assert train_quality(docs, labels.limit(0)) is None
    assert score_documents(docs.limit(0), train_quality(docs.limit(0), labels)).count() == 0


def test_stages_in_order(spark, given):
    """Each stage against what it is to do, on the smallest table."""
    sf_dir = "/root/testdata/sf0.001"
    docs, rows = given("documents")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, sf_dir), name)
        out[name] = docs
        if name != "packing":
            assert docs.columns == corpus_pipeline.COLUMNS
    text = {r[0]: r[1] for r in rows}
    good = {r.doc_id: r for r in out["quality"].collect()}
    assert all(r.text == text[i] for i, r in good.items())
    quality = {r[0]: r[1] for r in given("labels")[1]}
    assert sum(i in good for i, q in quality.items() if q == 1) >= 0.97 * sum(q == 1 for q in quality.values())
    parts = {r.doc_id: r.component_id for r in jaccard_components(out["quality"], 5, 80).collect()}
    kept = {r.doc_id: r for r in out["near_duplicates"].collect()}
    assert set(kept) == {i for i, c in parts.items() if i == c}
    clean = {r.doc_id: r for r in out["personal_data"].collect()}
    assert set(clean) == set(kept)
    for i, r in clean.items():
        assert not re.search(r"[a-z0-9]@[a-z0-9-]+\.[a-z]", r.text) and r.n_chars == len(r.text)
        assert re.sub(r"\[\w+\]", "", r.text) == kept[i].text or "[" in r.text
    mixed = out["mixing"].collect()
    assert all(clean[r.doc_id].text.startswith(r.text[:1000].rstrip()) or r.text in clean[r.doc_id].text for r in mixed)
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    total = sum(words(r.text) for r in clean.values())
    assert sum(words(r.text) for r in mixed) == pytest.approx(1.5 * total, abs=25)
    pieces = out["packing"]
    per = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.countDistinct("doc_tokens").alias("k")).collect()
    assert {r.doc_id for r in per} == {r.doc_id for r in mixed}


def test_stages_of_awkward_and_empty_tables(spark, documents, awkward, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    ids = [None, None, *range(2, len(awkward))]
    sources = [None, "a", "b"] * 5
    for texts, n in ((awkward, len(awkward)), ([], 0)):
        docs = documents(texts, ids[:n], sources[:n])
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialise(stage(spark, docs, str(tmp_path)), name)
        assert (docs.count() > 0) == (n > 0)


def test_registration():
    entry = importlib.import_module("__spark_entry__")
    names = entry.queries()
    assert "pipeline" in names and {f"op{i}" for i in range(1, 14)} == {
        n.split("_")[0] for n in names if re.match(r"op\d+_", n)
    }
