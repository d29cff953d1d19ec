"""Learned abbreviations and the sentences they keep whole."""

import math

import pytest
from pyspark.sql import functions as F

from textlens import MarkerScorer, SentimentAnalyzer, score_sentiment
from textlens.operators import sentences as O
from textlens.operators.abbreviations import MARK, Abbreviations, fit_abbreviations, strength, word_counts
from textlens.session import shared_path
from textlens.sources.sinks import read_runs
from textlens.streaming.score_stream import read_batches, read_stream, score_stream_in_batches

CORPUS = [
    "Dr. Smith met Mrs. Jones at noon. They talked about Dr. Brown.",
    "She saw Dr. Adams there. The meeting was short.", "Mrs. Lee left early. Then Dr. Smith spoke.", "It was noon, and the talk was short.",
    "We brought pens, paper, etc. for all of them. Then more came, pens, etc. and more.", "He said etc. often. That was it etc. The end was near.",
    "Dr. Gray and Mrs. Gray walked there at noon and talked.", "Then they met, and they left.",
] * 4


@pytest.fixture
def corpus(spark):
    return spark.createDataFrame(list(enumerate(CORPUS)), "id int, text string")


def split(spark, learned, text):
    return spark.createDataFrame([(text,)], "text string").select(learned.sentences("text")).first()[0]


def test_learned_from_the_texts(spark, corpus):
    learned = fit_abbreviations(corpus, "text")
    assert learned.entries == {"dr": True, "mrs": True, "etc": False}
    assert split(spark, learned, "Dr. Smith came. He left.") == ["Dr. Smith came.", "He left."]
    assert split(spark, learned, "Pens etc. for all. See etc. The end.") == ["Pens etc. for all.", "See etc.", "The end."]


def test_measure_by_hand(spark, corpus):
    rows = {r["word"]: r for r in word_counts(corpus, "text").withColumn("x", strength(0.2)).collect()}
    assert (rows["dr"]["with_period"], rows["dr"]["without"], rows["dr"]["capital_after"]) == (20, 0, 20)
    assert rows["dr"]["x"] == pytest.approx(2 * 20 * (math.log(0.99) - math.log(0.2)) * math.exp(-2))
    n, k = rows["noon"]["without"], rows["noon"]["with_period"]
    ratio = 2 * (k * math.log(0.99 / 0.2) + n * math.log(0.01 / 0.8))
    assert rows["noon"]["x"] == pytest.approx(ratio * math.exp(-4) * 4.0**-n)


def test_odd_texts(spark):
    learned = Abbreviations({"dr": True, "u.s": True, "etc": False})
    got = lambda text: split(spark, learned, text)
    assert got(None) is None and got("") == [] and got(" \n ") == []
    assert got("(Dr. Who) met \"Dr.\n Strange\". He ran") == ["(Dr. Who) met \"Dr.\n Strange\".", "He ran"]
    assert got("In the U.S. Army. Yes! etc. no") == ["In the U.S. Army.", "Yes!", "etc. no"]
    assert got("dr.") == ["dr."] and got("Dr. Dr. Dr. X") == ["Dr. Dr. Dr. X"]
    assert got(f"a.{MARK} b. c") == ["a.", "b.", "c"]
    long_ = "Dr. Smith ran. " * 20_000
    assert len(got(long_)) == 20_000


def test_without_entries_like_the_plain_split(spark, corpus):
    from textlens.functions.text import sentences

    rows = corpus.select(sentences("text").alias("a"), Abbreviations().sentences("text").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows)
    assert fit_abbreviations(corpus.limit(0), "text").entries == {}


def test_scores_use_them(spark):
    df = spark.createDataFrame([(1, "Dr. Good came. Bad.")], "id int, text string")
    marks = MarkerScorer({"LABEL_0": ("bad",), "LABEL_1": ("none",), "LABEL_2": ("good",)}, 10.0)
    row = score_sentiment(df, "text", marks, abbreviations=Abbreviations({"dr": True})).first()
    assert row["sentences_array"] == ["Dr. Good came.", "Bad."] and len(row["sentence_sentiments_lst"]) == 2


# Run records of work that runs later ------------------------------------------------------------


class Failing(MarkerScorer):
    def logits(self, state, texts):
        raise RuntimeError("the model broke")

    def column(self, text):
        raise AssertionError("only through the UDF")


MARKS = MarkerScorer({"LABEL_0": ("bad",), "LABEL_1": ("okay",), "LABEL_2": ("good",)}, 10.0)


def test_record_comes_from_the_run(spark):
    path = shared_path(spark, "runs")
    df = spark.createDataFrame([(i, "good. bad.") for i in range(50)], "id int, text string")
    make = lambda scorer: SentimentAnalyzer(spark, 7, scorers={"roberta": scorer}, run_log_path=path)
    count = lambda scored: scored.write.format("noop").mode("overwrite").save()
    assert make(MARKS).trigger_SentimentInference(df, action=count) is None
    with pytest.raises(Exception, match="the model broke"):
        make(Failing(MARKS.markers, 10.0)).trigger_SentimentInference(df, action=count)
    make(Failing(MARKS.markers, 10.0)).trigger_SentimentInference(df)  # nothing runs
    runs = read_runs(spark, path).orderBy("started_at").collect()
    assert [r["success"] for r in runs] == [1.0, 0.0, None]
    assert [r["metrics"] for r in runs] == [{"rows": 50.0}, {}, {}]
    assert "broke" in runs[1]["error"]


def test_call_size_reaches_the_model_and_changes_nothing(spark, tmp_path):
    class Sized(MarkerScorer):
        def logits(self, state, texts):
            with open(f"{tmp_path}/calls", "a") as out:
                out.write(f"{len(texts)}\n")
            return super().logits(state, texts)

    df = spark.createDataFrame([(i, "good " * (i % 13) + "bad. " * (i % 5)) for i in range(100)], "id int, text string").coalesce(1)
    sized = Sized(MARKS.markers, 10.0)
    plain = {r["id"]: r["doc_sentiments"] for r in score_sentiment(df, "text", MARKS, level="document").collect()}
    for n in (1, 7, 1000):
        scored = score_sentiment(df, "text", sized, level="document", call_size=n)
        assert {r["id"]: r["doc_sentiments"] for r in scored.collect()} == plain
        sizes = [int(x) for x in open(f"{tmp_path}/calls")]
        assert max(sizes) == min(n, 100) and sum(sizes) >= 100
        open(f"{tmp_path}/calls", "w").close()
    with pytest.raises(ValueError):
        score_sentiment(df, "text", MARKS, call_size=0)


def test_batches_of_a_stream_equal_the_table(spark, tmp_path):
    rows = [(i, "good. bad. okay." if i % 3 else None) for i in range(30)] + [(1, "good."), (None, "bad. good.")]
    df = spark.createDataFrame(rows, "id int, text string")
    source, sink, log = (f"{tmp_path}/{n}" for n in ("in", "out", "log"))
    score = lambda t: score_sentiment(t, "text", MARKS, by_rows=True)

    def run():
        stream = read_stream(spark, source, df.schema, max_files_per_trigger=1)
        score_stream_in_batches(stream, score, sink, log).awaitTermination()
        return sorted(map(str, read_batches(spark, sink).select("id", "text", "sentence_sentiments_lst").collect()))

    df.where("id < 10").repartition(2).write.mode("append").parquet(source)
    run()
    df.where("id >= 10 OR id IS NULL").repartition(2).write.mode("append").parquet(source)
    again = run()  # a restart: only new files
    assert again == sorted(map(str, score_sentiment(df, "text", MARKS).select("id", "text", "sentence_sentiments_lst").collect()))
    # A batch that runs twice replaces its folder.
    score(df.limit(1)).write.mode("overwrite").parquet(f"{sink}/batch=0")
    assert len(read_batches(spark, sink).select("id").collect()) < len(again)


def test_regroup_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(None, "a. b."), (1, "c."), (2, "")], "id int, text string")
    rows = O.explode_sentences(df, ["id"], "text")
    got = {r["id"]: r["again"] for r in O.regroup_sentences(df, rows, ["id"], "sentence", "again").collect()}
    assert got == {None: ["a.", "b."], 1: ["c."], 2: []}
    twice = df.union(df)
    with pytest.raises(Exception, match="do not identify"):
        O.regroup_sentences(twice, O.explode_sentences(twice, ["id"], "text"), ["id"], "sentence", "again").collect()


def test_sizing_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sizing", "sizing")
    df = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    O.repartition_by_rows(df)
    O.repartition_by_rows(df, rows=1000)
    O.spread(df, ["k"])
    assert len(tracker.getJobIdsForGroup("sizing")) == 0


def test_words_are_counted_before_patterns_read_them(spark):
    """Two aggregates: words as they stand, then the words that patterns find in them."""
    from textlens.operators.abbreviations import word_counts

    df = spark.createDataFrame([("Dr. Smith met dr. jones, etc.",), (None,), ("",), ("a. (B) A",)], "text string")
    counts = word_counts(df, "text")
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [") == 2
    found = {r["word"]: tuple(r)[1:] for r in counts.collect()}
    assert found["dr"] == (2, 0, 1, 2) and found["etc"] == (1, 0, 0, 0) and found["a"] == (1, 1, 1, 1)
