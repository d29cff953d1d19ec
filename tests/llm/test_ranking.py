"""The pairwise ranker: features against plain counting, held-out accuracy, odd inputs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlens.llm import queries, ranking as R
from textlens.llm.words import table

SF = "/root/testdata/sf0.01"


def named(text):
    return dict(zip(R.NAMES, R.features([text.encode()])[0]))


def test_features_by_counting():
    text = "One two, two two! ÄB 12 ***\nOne two, two"
    words = text.split()
    x = named(text)
    assert x["log_bytes"] == pytest.approx(math.log1p(len(text.encode())))
    assert x["log_words"] == pytest.approx(math.log1p(len(words)))
    assert x["sign_rate"] == pytest.approx(math.log1p(3 / len(words)))
    assert x["upper_share"] == pytest.approx(3 / sum(c.isascii() and c.isalpha() for c in text))
    assert x["bare_words"] == pytest.approx(1 / len(words))
    assert x["distinct"] == pytest.approx(len(set(words)) / len(words))
    assert x["after_itself"] == 0
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    assert x["repeated_windows"] == pytest.approx(1 - len(set(windows)) / len(windows))


def test_features_do_not_depend_on_neighbours():
    texts = ["", "a", "a a a a", "The end.", "x" * 5000, " \n ", "a b c a b c"]
    together = R.features([t.encode() for t in texts])
    for k, t in enumerate(texts):
        assert np.allclose(together[k], R.features([t.encode()])[0])
    assert not together[0].any()
    assert together[2][R.NAMES.index("after_itself")] == pytest.approx(3 / 4)


def test_held_out_accuracy(spark):
    rows = queries.op12_quality_classifier(spark, SF).join(table(spark, SF, "labels"), "doc_id").where("held_out").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert len(bad) >= 5
    assert np.mean([g > b for g in good for b in bad]) > 0.98
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.97


def test_threshold_is_the_share_of_label_0(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    ranker = R.fit(docs, labels, ~R.held_out())
    scored = ranker.score(docs.select("doc_id", "text")).join(labels, "doc_id").where(~R.held_out())
    low, zero = scored.agg(F.sum((F.col("score") < R.THRESHOLD).cast("int")), F.sum((F.col("quality") == 0).cast("int"))).first()
    assert low == zero


def test_pairs_use_every_document(spark):
    rows = spark.createDataFrame([(i, int(i % 4 != 0), [float(i)]) for i in range(40)], "id long, label int, x array<double>")
    pairs = R.preference_pairs(rows, 3).collect()
    assert len(pairs) == 90 and {p["good"][0] % 4 == 0 for p in pairs} == {False}
    bad = [p["bad"][0] for p in pairs]
    assert {bad.count(b) for b in set(bad)} == {9} and len(set(bad)) == 10


def test_labels_do_not_reach_scores(spark):
    """Held-out labels may say anything; lang, source and id too."""
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    turned = labels.withColumn("quality", F.when(R.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    odd = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    score = lambda d, l: {r["doc_id"]: round(r["score"], 9) for r in R.fit(d, l, ~R.held_out()).score(d).collect()}
    assert score(docs, labels) == score(odd, turned)


def test_odd_rows(spark):
    texts = [(1, "A fine text of some words."), (2, "$$$ %%% ###"), (2, "$$$ %%% ###"), (None, None), (None, "lost"), (3, ""), (4, "w " * 200_000)]
    docs = spark.createDataFrame([(i, t, 0.5, "x") for i, t in texts], "doc_id long, text string, score double, label string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 0), (None, 1), (3, None), (9, 0)], "doc_id long, quality int")
    scored = R.fit(docs, labels, F.lit(True)).score(docs).collect()
    assert len(scored) == len(texts) and all(0 <= r["score"] <= 1 for r in scored)
    by = {r["doc_id"]: r["score"] for r in scored}
    assert by[1] >= R.THRESHOLD > by[2]


def test_one_label_no_label_no_rows(spark):
    docs = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, quality int")
    score = lambda rows: R.fit(docs, labels(rows), F.lit(True)).score(docs).first()["score"]
    assert (score([(1, 1)]), score([(1, 0)]), score([])) == (1.0, 0.0, R.THRESHOLD)
    assert R.fit(docs.limit(0), labels([(1, 1)]), F.lit(True)).score(docs.limit(0)).count() == 0


def test_sample_bound(spark):
    labels = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    assert 1500 < R._sampled(labels, "doc_id", "quality", 2000).count() < 2500


def test_fit_takes_every_labelled_row(spark):
    """More rows than any sample: positions, pairs and the quantile are of all of them."""
    ids = spark.range(0, 30_000, 1, 8)
    labels = ids.select(F.col("id").alias("doc_id"), (F.col("id") % 3 != 0).cast("int").alias("quality"))
    clean = F.concat(F.lit("Some words of text "), F.col("id"), F.lit(", and more of them."))
    docs = ids.select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 != 0, clean).otherwise(F.concat(F.lit("$$ ## "), F.col("id"))).alias("text"))
    ranker = R.fit(docs, labels, F.lit(True))
    mean = docs.agg(F.avg(F.log1p(F.octet_length("text")))).first()[0]
    assert ranker.middle[R.NAMES.index("log_bytes")] == pytest.approx(mean, rel=1e-12)
    assert ranker.score(docs).where(F.col("score") < R.THRESHOLD).count() == 10_000


def test_places_are_gapless(spark):
    rows = spark.range(0, 1000, 1, 7).select((F.col("id") * 37 % 1000).alias("v"))
    found = R.placed(rows, "v").collect()
    assert len(found) == 1000 and all(r["at"] == r["v"] for r in found)
    assert R.placed(rows.limit(0), "v").count() == 0


def test_many_documents_of_the_rarer_label(spark, monkeypatch):
    """Pairs are the same, whether the rarer label is sent or dealt out."""
    rows = spark.createDataFrame([(i, int(i % 4 != 0), [float(i)]) for i in range(40)], "id long, label int, x array<double>")
    key = lambda pairs: sorted((p["good"][0], p["bad"][0]) for p in pairs.collect())
    sent = key(R.preference_pairs(rows, 3))
    monkeypatch.setattr(R, "SENT_ROWS", 0)
    assert key(R.preference_pairs(rows, 3)) == sent
