"""Labels, splits, metrics, reports and the classifier, against brute force on small fixtures."""

import hashlib
import math
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from textlens import TextClassifier
from textlens.operators import block_classifier as B
from textlens.operators import metrics as M
from textlens.operators import report as R
from textlens.operators.labels import LabelIndex, class_count, fit_label_index
from textlens.operators.split import stratified_split
from textlens.operators.block_classifier import BLOCK, BlockClassifier, Examples, Steps, hashed_words, pack

PREDICTIONS = [(0, 0)] * 5 + [(0, 1)] * 2 + [(1, 1)] * 3 + [(1, 3)] * 1
NAMES = ["ant", "bee", "cat", "dog"]  # cat: neither true nor predicted; dog: predicted only


@pytest.fixture
def index(spark):
    return LabelIndex.of(spark, NAMES)


@pytest.fixture
def pred(spark):
    return spark.createDataFrame(PREDICTIONS, "y_true bigint, y_pred bigint")


@pytest.mark.parametrize("max_local", [100, 2], ids=["local", "distributed"])
def test_label_index(spark, max_local):
    labels = ["é", "b", "a", "Z", "a|||b", "b", None, "a", "aa", "c"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(labels)], "id bigint, label string")
    index = fit_label_index(df.repartition(3), "label", max_local)
    assert (index.labels is None) == (max_local == 2)
    expected = {x: i for i, x in enumerate(sorted({x for x in labels if x}))}
    got = index.encode(df, "label", "class_id").collect()
    assert {row.label: row.class_id for row in got if row.label} == expected
    assert [row.class_id for row in got if row.label is None] == [None]
    assert index.size() == len(expected)
    assert class_count(df, "label").first()[0] == len(expected)


def test_large_label_index_is_numbered_across_partitions(spark):
    df = spark.range(5000).select((F.col("id") % 1700).cast("string").alias("label"))
    index = fit_label_index(df, "label", max_local=10)
    rows = index.table.orderBy("class_id").collect()
    assert [r.label for r in rows] == sorted(str(i) for i in range(1700))
    assert [r.class_id for r in rows] == list(range(1700))


def test_unseen_labels(spark, index):
    df = spark.createDataFrame([("ant",), ("elk",)], "label string")
    kept = index.encode(df, "label", "id", unseen="keep").collect()
    assert {row.label: row.id for row in kept} == {"ant": 0, "elk": 4}
    with pytest.raises(Exception, match="not seen"):
        index.encode(df, "label", "id").collect()
    with pytest.raises(ValueError):
        index.encode(df, "label", "id", unseen="guess")


def test_decode_returns_unknown_ids_unchanged(spark, index):
    df = spark.createDataFrame([("1",), ("17",), ("macro avg",), (None,)], "x string")
    got = {row.x: row.name for row in index.decode(df, "x", "name").collect()}
    assert got == {"1": "bee", "17": "17", "macro avg": "macro avg", None: None}


def brute_split(rows, holdout=0.1, seed=42):
    parts = {}
    for label in {x for _, x in rows}:
        keys = sorted(
            (k for k, x in rows if x == label), key=lambda k: (hashlib.md5(f"{seed}:{k}".encode()).hexdigest(), str(k))
        )

        def share(n):
            return 0 if len(keys) < 2 else math.floor(n * holdout + 0.5)

        test = share(len(keys))
        last = test + share(len(keys) - test)
        for place, key in enumerate(keys):
            parts[key] = "test" if place < test else "validation" if place < last else "train"
    return parts


ROWS = [(i, "hot" if i % 3 else ("warm" if i % 2 else f"rare{i // 200}")) for i in range(1500)] + [(9999, "single")]


@pytest.mark.parametrize(
    "options",
    [{}, {"ranked_rows": 5}, {"ranked_rows": 1, "digits_per_pass": 1}, {"max_local": 2}, {"ranked_rows": 5, "max_local": 1}],
    ids=str,
)
def test_split_equals_brute_force(spark, options):
    df = spark.createDataFrame(ROWS, "id bigint, label string")
    got = {row.id: row.split for row in stratified_split(df, "id", "label", **options).collect()}
    assert got == brute_split(ROWS)


def test_split_with_other_share_and_seed(spark):
    df = spark.createDataFrame(ROWS, "id bigint, label string")
    got = {row.id: row.split for row in stratified_split(df, "id", "label", holdout=0.3, seed=7).collect()}
    assert got == brute_split(ROWS, 0.3, 7)


def test_split_of_repeated_keys_keeps_them_together(spark):
    rows = [(i if i % 3 else 0, "a") for i in range(900)] + [(None, None)]
    df = spark.createDataFrame(rows, "id bigint, label string")
    got = stratified_split(df, "id", "label", ranked_rows=10).where("id is not null")
    assert got.groupBy("id").agg(F.countDistinct("split").alias("n")).where("n > 1").count() == 0
    assert got.count() == 900
    with pytest.raises(ValueError):
        stratified_split(df, "id", "label", holdout=1.5)


def test_counts_of_absent_and_never_predicted_classes(pred, index):
    counts = M.class_counts(M.confusion_cells(pred), index)
    got = {r.label_name: (r.support, r.tp, r.fp, r.fn) for r in counts.collect()}
    assert got == {"ant": (7, 5, 0, 2), "bee": (4, 3, 2, 1), "cat": (0, 0, 0, 0), "dog": (0, 0, 1, 0)}


def test_zero_denominators(pred, index):
    report = M.class_report(M.class_counts(M.confusion_cells(pred), index))
    got = {r.label_name: (r.precision, r.recall, r.f1_score) for r in report.collect()}
    assert got["cat"] == got["dog"] == (0.0, 0.0, 0.0)
    assert got["ant"] == pytest.approx((1.0, 5 / 7, 10 / 12))


def test_full_report_rows(pred, index):
    report = R.full_report(M.class_counts(M.confusion_cells(pred), index))
    rows = {r.label: r for r in report.collect()}
    assert set(rows) == {"0", "1", "2", "3", "accuracy", "macro avg", "weighted avg"}
    assert rows["accuracy"].accuracy == pytest.approx(8 / 11)
    assert rows["accuracy"].support is None and rows["accuracy"].precision is None
    assert rows["macro avg"].recall == pytest.approx((5 / 7 + 3 / 4 + 0) / 3)
    assert rows["weighted avg"].recall == pytest.approx(8 / 11)
    assert rows["macro avg"].support == 11 and rows["macro avg"].tp is None
    averages = {r.label_name: r for r in M.report_averages(M.class_report(M.class_counts(M.confusion_cells(pred), index))).collect()}
    for name in ("macro avg", "weighted avg"):
        assert averages[name].f1_score == pytest.approx(rows[name].f1_score)


def test_dense_confusion_matrix(pred):
    got = {(r.y_true, r.y_pred): r.n for r in M.confusion_matrix(M.confusion_cells(pred), 4).collect()}
    assert len(got) == 16 and sum(got.values()) == 11 and got[2, 2] == 0 and got[1, 3] == 1


def test_percentages_are_sorted_as_numbers(spark):
    rows = [("0", 0.095), ("1", 1.0), ("2", 0.85)]
    df = spark.createDataFrame(rows, "label string, f1_score double").select(
        "label", F.col("label").alias("label_name"), "f1_score", *[F.lit(None).cast("double").alias(c) for c in ("precision", "recall", "accuracy")],
        *[F.lit(None).cast("bigint").alias(c) for c in ("support", "tp", "fp", "fn")],
    )
    got = R.prediction_report(df).orderBy("rank").collect()
    assert [r.f1_score for r in got] == ["100.0%", "85.0%", "9.5%"]


def test_log_loss_clamps_and_weighs_rows_equally(spark):
    rows = [(0, [0.5, 0.5]), (1, [1.0, 0.0]), (1, [0.0, 1.0])]
    df = spark.createDataFrame(rows, "y_true bigint, probs array<double>")
    expected = (-math.log(0.5) - math.log(1e-15) - 0.0) / 3
    assert M.log_loss(df).first()[0] == pytest.approx(expected)
    summary = M.evaluation_summary(M.evaluate(df.withColumn("y_pred", F.lit(0)))).first()
    assert summary.avg_val_loss == pytest.approx(expected) and summary.accuracy == pytest.approx(1 / 3)


def long_table(spark, index):
    rows = [("dev-set", 1, t, p) for t, p in PREDICTIONS] + [("test-set", 2, t, p) for t, p in PREDICTIONS[:8]]
    df = spark.createDataFrame(rows, "phase string, epoch bigint, y_true bigint, y_pred bigint")
    groups = ["phase", "epoch"]
    cells = M.confusion_cells(df, groups=groups)
    counts = M.class_counts(cells, index, groups, [("dev-set", 1), ("test-set", 2)])
    return R.metrics_long(R.full_report(counts, groups))


def test_report_tables(spark, index):
    long = long_table(spark, index)
    assert long.count() == 2 * (4 + 2)
    assert R.latest_epoch(long).first()[0] == 2
    pivot = R.comparative_pivot(long, [("test-set", 2), ("dev-set", 1)], pretty=True).orderBy("rank")
    assert pivot.columns[:5] == ["rank", "label", "label_name", "f1_score__dev_set__1", "f1_score__test_set__2"]
    names = [row.label_name for row in pivot.collect()]
    assert names[0] == "ant" and names[-2:] == ["macro avg", "weighted avg"]
    with pytest.raises(ValueError):
        R.comparative_pivot(long, [("dev-set", 1)])
    series = R.metric_series(long)
    assert series.count() == 3 * long.count()
    assert {r.trace_name for r in series.collect()} >= {"00 - ant", "macro avg - macro avg"}


def test_groups_must_be_listed(pred, index):
    cells = M.confusion_cells(pred.withColumn("phase", F.lit("x")), groups=["phase"])
    with pytest.raises(ValueError):
        M.class_counts(cells, index, ["phase"])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), min_size=1, max_size=60))
def test_metric_identities(spark, index, pairs):
    df = spark.createDataFrame(pairs, "y_true bigint, y_pred bigint")
    cells = M.confusion_cells(df)
    report = {r.label: r for r in R.full_report(M.class_counts(cells, index)).collect()}
    classes = [report[str(i)] for i in range(4)]
    right = sum(t == p for t, p in pairs)
    assert sum(c.support for c in classes) == len(pairs)
    assert sum(c.tp for c in classes) == right
    assert sum(c.fp for c in classes) == sum(c.fn for c in classes) == len(pairs) - right
    assert report["weighted avg"].recall == pytest.approx(report["accuracy"].accuracy)
    truth, guess = Counter(t for t, _ in pairs), Counter(p for _, p in pairs)
    for i, c in enumerate(classes):
        hits = sum(t == p == i for t, p in pairs)
        assert c.precision == pytest.approx(hits / guess[i] if guess[i] else 0.0)
        assert c.recall == pytest.approx(hits / truth[i] if truth[i] else 0.0)


COLORS = {"red": "rose fire", "blue": "sea sky", "green": "leaf grass"}


@pytest.fixture(scope="module")
def products(spark):
    rows = [(i, name, f"{words} item {i % 7}", "x" if i % 2 else None)
            for i, (name, words) in enumerate(list(COLORS.items()) * 40)]
    return spark.createDataFrame(rows, "id bigint, label string, product string, category string")


def test_classifier_life(spark, products, tmp_path):
    trained = TextClassifier(spark, str(tmp_path), "colors")
    result = trained.train_and_evaluate(
        products, ["product", "category"], "label", "id", epochs=2, num_features=256, select_best="f1_score"
    )
    phases = {(r.phase, r.epoch): r for r in result.summary.collect()}
    assert set(phases) == {("dev-set", 1), ("dev-set", 2), ("test-set", 3)}
    assert phases["test-set", 3].support == 12
    assert result.training_loss == sorted(result.training_loss, reverse=True)
    assert result.metrics.count() == 3 * (3 + 2) and result.pivot.count() == 5

    loaded = TextClassifier(spark, str(tmp_path), "colors")
    predicted, report = loaded.predict(products, ["product", "category"], "label")
    assert predicted.columns == [*products.columns, "input_text", "Predicted"]
    assert predicted.where("Predicted = label").count() == 120
    assert loaded.index.labels == ("blue", "green", "red")
    assert "None" in predicted.where("category is null").first()["input_text"]
    rows = report.orderBy("rank").collect()
    assert [r.f1_score for r in rows[:3]] == ["100.0%"] * 3 and rows[-1].label == "weighted avg"
    unlabelled, nothing = loaded.predict(products.drop("label"), ["product", "category"], use_checkpoint=False)
    assert nothing is None and unlabelled.count() == 120
    strange = products.withColumn("label", F.lit("pink"))
    kept = loaded.predict(strange, ["product"], "label", use_checkpoint=False, unseen="keep")[1]
    assert kept.where("label = '3'").first()["support"] == 120


def test_training_without_key_column(spark, products):
    result = TextClassifier(spark).train_and_evaluate(
        products, ["product"], "label", epochs=1, num_features=64, save=False
    )
    assert result.summary.where("phase = 'dev-set'").count() == 1


def test_classifier_limits(spark, products):
    with pytest.raises(ValueError):
        BlockClassifier(spark, 1, 10)
    for options in ({"epochs": 0}, {"batch_size": 0}, {"learning_rate": 0.0}):
        with pytest.raises(ValueError):
            TextClassifier(spark).train_and_evaluate(products, ["product"], "label", "id", **options)
    with pytest.raises(ValueError):
        TextClassifier(spark).predict(products, ["product"], use_checkpoint=False)


def many_classes(spark, classes=70, copies=4):
    rows = [(c * copies + k, c, f"word{c} common filler{k}") for c in range(classes) for k in range(copies)]
    df = spark.createDataFrame(rows, "id bigint, y bigint, text string")
    return df.select("id", "y", hashed_words(F.col("text"), 1 << 16).alias("words"))


def trained_on(spark, rows, classes, epochs, **options):
    chunks, model, losses = pack(rows, 1 << 16, values=300), BlockClassifier(spark, classes, 1 << 16), []
    for epoch in range(1, epochs + 1):
        model, loss = model.train_epoch(chunks, epoch, Steps(**options))
        losses.append(loss)
    return model, losses


def test_blocks_of_classes(spark):
    """More classes than a block holds: epochs continue, and scoring by blocks equals scoring where the rows stand."""
    rows, classes = many_classes(spark), 70
    assert classes > 2 * BLOCK and classes % BLOCK
    model, losses = trained_on(spark, rows, classes, 4, batch_size=8, learning_rate=1.0)
    assert losses == sorted(losses, reverse=True) and losses[0] > 1.5 * losses[-1]
    wanted = rows.withColumn("payload", F.struct("id"))
    here = {r["payload"]["id"]: r for r in model.score(wanted).collect()}
    apart = BlockClassifier(spark, classes, 1 << 16, model.weights, sent_bytes=0)
    assert apart.sent() is None and model.sent() is not None
    there = {r["payload"]["id"]: r for r in apart.score(wanted).collect()}
    assert here.keys() == there.keys() and len(here) == 280
    for key, row in here.items():
        assert row["y_pred"] == there[key]["y_pred"] == row["y"]
        assert row["p_true"] == pytest.approx(there[key]["p_true"], rel=1e-4) == row["p_pred"]


def test_first_step_is_the_gradient(spark):
    """One example, one step, by hand: Adagrad on the logistic loss of each class."""
    rows = spark.createDataFrame([(0, [5])], "y bigint, words array<int>")
    model, (loss,) = trained_on(spark, rows, 3, 1, batch_size=1, learning_rate=0.5)
    start, p = -math.log(2), 1 / 3
    assert loss == pytest.approx(-math.log(p) - 2 * math.log(1 - p), rel=1e-5)
    got = {r["feature"]: r["w"] for r in model.weights.collect()}
    for feature, first in ((5, 0.0), (1 << 16, start)):
        for c, w in enumerate(got[feature]):
            g = p - (c == 0)
            assert w == pytest.approx(first - 0.5 * g / math.sqrt(g * g + 0.1), rel=1e-4)


def test_batch_size_and_rate_matter(spark):
    rows = many_classes(spark, 8)
    run = lambda **options: trained_on(spark, rows, 8, 1, **options)[1][0]
    assert run(batch_size=1) != run(batch_size=32)
    assert run(batch_size=4, learning_rate=0.5) < run(batch_size=4, learning_rate=0.01)


def test_examples(spark):
    import numpy as np
    import pyarrow as pa

    x = Examples.of(pa.array([[3, 1, 3], [], [9]], pa.list_(pa.int32())), 10)
    assert x.edges.tolist() == [0, 3, 4, 6] and x.feature.tolist() == [1, 3, 10, 10, 9, 10]
    length = math.hypot(math.log(2), math.log(3))
    assert x.value.tolist() == pytest.approx([math.log(2) / length, math.log(3) / length, 1, 1, 1, 1])
    assert list(x.cut(3)) == [(0, 1), (1, 3)] and list(x.cut(100)) == [(0, 3)] and list(x.cut(1)) == [(0, 1), (1, 2), (2, 3)]
    assert np.allclose(x.scores(np.array([[2.0]], np.float32), np.array([-1, -1, 0, 0, 0, 0]))[:, 0], [2, 2, 4])


def test_many_classes_end_to_end(spark, tmp_path):
    rows = [(i, f"label{i % 40}", f"word{i % 40} item") for i in range(800)]
    df = spark.createDataFrame(rows, "id bigint, label string, product string")
    trained = TextClassifier(spark, str(tmp_path), "many")
    result = trained.train_and_evaluate(df, ["product"], "label", "id", epochs=3, batch_size=16, learning_rate=1.0)
    assert [r["epoch"] for r in result.losses.orderBy("epoch").collect()] == [1, 2, 3]
    assert result.summary.where("phase = 'test-set'").first()["accuracy"] == 1.0
    loaded = TextClassifier(spark, str(tmp_path), "many").load()
    loaded.model.sent_bytes = 0
    predicted, report = loaded.predict(df, ["product"], "label", use_checkpoint=False)
    assert predicted.where("Predicted = label").count() == 800 and report.count() == 43


def test_examples_take_bounded_memory(monkeypatch):
    """A large Arrow batch is counted in pieces: the same examples, and little beside words and result."""
    rng = np.random.default_rng(1)
    sizes = rng.integers(0, 2000, 4000)
    edges = pa.array(np.concatenate(([0], np.cumsum(sizes))).astype(np.int32))
    words = pa.ListArray.from_arrays(edges, pa.array(rng.integers(0, 1 << 18, sizes.sum()).astype(np.int32)))
    tracemalloc.start()
    pieces = B.Examples.of(words, 1 << 18)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30 * len(words.flatten())
    monkeypatch.setattr(B, "WORDS_AT_ONCE", 1 << 40)
    whole = B.Examples.of(words, 1 << 18)
    for name in ("edges", "feature", "value"):
        assert np.array_equal(getattr(pieces, name), getattr(whole, name))
    assert [b - a for a, b in B.word_ranges(pa.array([None, [1], []], pa.list_(pa.int32())))] == [3]


def test_spans_of_blocks(spark, monkeypatch):
    """A chunk of few features meets its blocks at once; steps on a matrix equal steps on single values, block by block."""
    rows, model = many_classes(spark), BlockClassifier(spark, 70, 1 << 16)
    chunks = pack(rows, 1 << 16, values=300)
    assert model._dealt(chunks).count() == chunks.count()
    wide, loss = model.train_epoch(chunks, 1, Steps(batch_size=8))
    monkeypatch.setattr(B, "UNIT_WEIGHTS", 1)
    monkeypatch.setattr(B, "SPARSE", 0)
    chunks = pack(rows, 1 << 16, values=300)
    assert model._dealt(chunks).count() == model.blocks * chunks.count()
    narrow, same = model.train_epoch(chunks, 1, Steps(batch_size=8))
    assert loss == pytest.approx(same, rel=1e-4)
    weights = lambda m: {(r["block"], r["feature"]): r["w"] for r in m.weights.collect()}
    one, other = weights(wide), weights(narrow)
    assert one.keys() == other.keys()
    for key, w in one.items():
        assert w == pytest.approx(other[key], abs=1e-4)
