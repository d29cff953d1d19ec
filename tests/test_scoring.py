"""Scorers, batch modes, the entry points, run records and streams."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlens import Lexicon, MarkerScorer, OnnxScorer, PhraseLexicon, Rules, SentimentAnalyzer, score_sentiment
from textlens.functions import scores as S
from textlens.functions.lexicon_rules import RuleLexicon
from textlens.operators import sentences as O
from textlens.operators.scoring import map_labels, model_logits
from textlens.plans.sentiment import ensemble_score
from textlens.session import shared_path
from textlens.sources.readers import inline_table, read_csv, read_lexicon, string_schema
from textlens.sources.sinks import materialise, read_runs
from textlens.streaming.score_stream import read_stream, score_stream
from tests.onnx_file import write_classifier

MARKS = MarkerScorer({"LABEL_0": ("bad", "worst"), "LABEL_1": ("okay",), "LABEL_2": ("good", "love")}, 10.0)
LEXICON = Lexicon({"love": 3.2, "worst": -3.1, "best": 3.2, "great": 3.1, "okay": 0.9, "terrible": -2.1, "better": 1.9})
REVIEWS = [
    (1, "We love this sturdy little lamp! It arrived on a Tuesday."),
    (2, "The worst purchase of my whole year. Still the best box to carry things in."),
    (3, "An okay chair, and the colour is great. Perhaps a better one will follow."),
]


@pytest.fixture
def reviews(spark):
    return inline_table(spark, REVIEWS, "id bigint, reviews string")


@pytest.fixture
def holes(spark):
    return inline_table(spark, [(1, None), (2, ""), (3, "good. bad."), (4, "  ")], "id bigint, text string")


def column(df, name, key="id"):
    return {row[key]: row[name] for row in df.collect()}


def test_review_sentences(reviews):
    scored = score_sentiment(reviews, "reviews", LEXICON)
    assert scored.columns == ["id", "reviews", "sentences_array", "sentence_sentiments_lst"]
    got = column(scored, "sentence_sentiments_lst")
    assert {k: [np.sign(x) for x in v] for k, v in got.items()} == {1: [1, 0], 2: [-1, 1], 3: [1, 1]}
    binary = column(score_sentiment(reviews, "reviews", LEXICON, binarize=True), "sentence_sentiments_lst")
    assert binary == {1: [1.0, 0.0], 2: [-1.0, 1.0], 3: [1.0, 1.0]}


@pytest.mark.parametrize("scorer", [LEXICON, MARKS], ids=["lexicon", "model"])
def test_null_and_empty_texts(holes, scorer):
    sentences = column(score_sentiment(holes, "text", scorer), "sentence_sentiments_lst")
    assert sentences[1] is None and sentences[2] == [] and sentences[4] == [] and len(sentences[3]) == 2
    documents = column(score_sentiment(holes, "text", scorer, level="document", binarize=True), "doc_sentiments")
    assert documents[1] is None and documents[2] is not None


def test_a_batch_without_any_sentence(spark):
    empty = spark.createDataFrame([(1, ""), (2, None), (3, " ")], "id bigint, text string").coalesce(1)
    assert column(score_sentiment(empty, "text", MARKS), "sentence_sentiments_lst") == {1: [], 2: None, 3: []}


def test_score_modes_differ(spark):
    df = spark.createDataFrame([(1, "okay okay bad")], "id bigint, text string")
    signed = column(score_sentiment(df, "text", MARKS, level="document"), "doc_sentiments")[1]
    difference = column(
        score_sentiment(df, "text", MARKS, level="document", score_mode="prob_diff"), "doc_sentiments"
    )[1]
    logits = np.array([1 / 3, 2 / 3, 0.0]) * 10
    probs = np.exp(logits) / np.exp(logits).sum()
    assert signed == pytest.approx(probs[1] - 0.5)
    assert difference == pytest.approx(probs[2] - probs[0])


def test_lexicon_table_small_is_inlined_and_large_is_joined(spark, holes, reviews):
    table = spark.createDataFrame(list(LEXICON.entries.items()), "token string, valence double")
    renamed = reviews.withColumnRenamed("reviews", "text").unionByName(holes.withColumn("id", F.col("id") + 10))
    for level, name in (("sentence", "sentence_sentiments_lst"), ("document", "doc_sentiments")):
        plain = column(score_sentiment(renamed, "text", LEXICON, level=level, binarize=True), name)
        inlined = column(score_sentiment(renamed, "text", table, level=level, binarize=True), name)
        joined = score_sentiment(renamed, "text", table, level=level, binarize=True, keys=["id"], max_inline=0)
        assert plain == inlined == column(joined, name)
        keyless = score_sentiment(renamed, "text", table, level=level, binarize=True, max_inline=0)
        assert plain == column(keyless, name) and keyless.columns == joined.columns


def test_null_and_repeated_keys_keep_their_own_scores(spark):
    rows = [(None, "great. worst."), (2, "great."), (2, "worst. worst."), (2, "great."), (None, None), (3, "")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    table = spark.createDataFrame(list(LEXICON.entries.items()), "token string, valence double")
    for level, name in (("sentence", "sentence_sentiments_lst"), ("document", "doc_sentiments")):
        found = [score_sentiment(df, "text", LEXICON, level=level)]
        found += [score_sentiment(df, "text", table, level=level, keys=["id"], max_inline=n) for n in (0, 100)]
        one, *others = [sorted(((r["id"], r["text"], r[name]) for r in f.collect()), key=str) for f in found]
        assert all(o == one for o in others)
    plain = sorted((tuple(r) for r in score_sentiment(df, "text", MARKS).collect()), key=str)
    assert plain == sorted((tuple(r) for r in score_sentiment(df, "text", MARKS, by_rows=True).collect()), key=str)


def test_a_lexicon_gives_the_same_scores_on_both_sides_of_the_inline_limit(spark, holes):
    entries = [(f"w{k}", 1.0) for k in range(9)] + [("good", 2.0)]
    table = spark.createDataFrame(entries, "token string, valence double")
    found = [column(score_sentiment(holes, "text", table, level="document", max_inline=n), "doc_sentiments") for n in (9, 10)]
    assert found[0] == found[1]


def test_arguments_are_checked_before_planning(reviews):
    for bad in ({"level": "word"}, {"score_mode": "x"}, {"batching": "sometimes"}, {"model": "unheard-of"}):
        with pytest.raises(ValueError):
            score_sentiment(reviews, "reviews", LEXICON, **bad)
    with pytest.raises(ValueError):
        score_sentiment(reviews, "nothing", LEXICON)


def test_scoring_by_rows_equals_in_place(holes):
    for binarize in (False, True):
        plain = score_sentiment(holes, "text", MARKS, binarize=binarize)
        rows = score_sentiment(holes, "text", MARKS, binarize=binarize, keys=["id"], by_rows=True)
        assert column(plain, "sentence_sentiments_lst") == column(rows, "sentence_sentiments_lst")
    with pytest.raises(ValueError):
        score_sentiment(holes, "text", LEXICON, by_rows=True, keys=["id"])


def test_lexicon_file(spark, tmp_path):
    (tmp_path / "lexicon.txt").write_text('great\t3.1\t0.8\t[3, 4]\n:"\t-1.5\t1\t[1]\n')
    table = read_lexicon(spark, str(tmp_path / "lexicon.txt"))
    assert {row.token: row.valence for row in table.collect()} == {"great": 3.1, ':"': -1.5}
    assert RuleLexicon.from_table(table).entries["great"] == 3.1


def test_truncation_is_opt_in(spark):
    df = spark.createDataFrame([(1, "worst thing best best best")], "id bigint, text string")
    whole = column(score_sentiment(df, "text", LEXICON, level="document", binarize=True), "doc_sentiments")
    cut = column(score_sentiment(df, "text", LEXICON, level="document", binarize=True, max_tokens=2), "doc_sentiments")
    assert whole == {1: 1.0} and cut == {1: -1.0}


def test_udf_equals_column_form(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    both = docs.select(model_logits(MARKS, F.col("text")).alias("a"), MARKS.column(F.col("text")).alias("b"))
    far = F.exists(F.zip_with("a", "b", lambda x, y: F.abs(x - y)), lambda d: d > 1e-9)
    assert both.where(far).count() == 0


class CountingScorer(MarkerScorer):
    """Leaves a file per model load and refuses calls above a size."""

    def __init__(self, folder, largest):
        super().__init__(MARKS.markers, 10.0)
        self.folder, self.largest = folder, largest

    def load(self):
        import os
        import uuid

        with open(os.path.join(self.folder, f"{os.getpid()}-{uuid.uuid4().hex}"), "w"):
            pass
        return super().load()

    def logits(self, state, texts):
        assert len(texts) <= self.largest
        return super().logits(state, texts)


@pytest.fixture
def by_value():
    import sys

    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    yield
    cloudpickle.unregister_pickle_by_value(sys.modules[__name__])


def test_model_loads_once_per_worker_not_per_task(spark, tmp_path, by_value):
    scorer = CountingScorer(str(tmp_path), 10**9)
    df = spark.range(400).select(F.lit("good bad").alias("text")).repartition(40)
    assert score_sentiment(df, "text", scorer, level="document").where("doc_sentiments is not null").count() == 400
    loads = os.listdir(tmp_path)
    assert len(loads) == len({name.split("-")[0] for name in loads}) < 40


def test_slices_bound_a_model_call(spark, tmp_path, by_value, monkeypatch):
    from textlens.operators import scoring

    monkeypatch.setitem(scoring.BATCH_SIZES, "dynamic", {"document": 7, "sentence": 5})
    texts = [(i, "good. bad. okay! " * (i % 4)) for i in range(50)]
    df = spark.createDataFrame(texts, "id bigint, text string").coalesce(1)
    small_calls = score_sentiment(df, "text", CountingScorer(str(tmp_path), 5))
    assert column(small_calls, "sentence_sentiments_lst") == column(
        score_sentiment(df, "text", MARKS, batching="none"), "sentence_sentiments_lst"
    )


@pytest.fixture
def onnx(tmp_path):
    tokenizers = pytest.importorskip("tokenizers")
    pytest.importorskip("onnxruntime")
    vocabulary = {"[PAD]": 0, "[UNK]": 1, "good": 2, "bad": 3, "okay": 4}
    tokenizer = tokenizers.Tokenizer(tokenizers.models.WordLevel(vocabulary, unk_token="[UNK]"))
    tokenizer.pre_tokenizer = tokenizers.pre_tokenizers.Whitespace()
    tokenizer.save(str(tmp_path / "tokenizer.json"))
    # A padding row that would show if the mask were ignored.
    weights = [[9, 9, 9], [0, 0.1, 0], [0, 0, 2], [2, 0, 0], [0, 3, 0]]
    write_classifier(tmp_path / "model.onnx", weights)
    labels = ("LABEL_0", "LABEL_1", "LABEL_2")
    return OnnxScorer(str(tmp_path / "model.onnx"), str(tmp_path / "tokenizer.json"), labels, max_length=4, batch_size=2)


def test_onnx_model(spark, onnx):
    rows = [(1, "good"), (2, "bad bad strange"), (3, "okay good"), (4, None), (5, "bad x x x good good good good")]
    df = spark.createDataFrame(rows, "id bigint, text string")
    logits = column(df.select("id", model_logits(onnx, F.col("text")).alias("l")), "l")
    assert logits[1] == pytest.approx([0, 0, 2])
    assert logits[2] == pytest.approx([4, 0.1, 0])
    assert logits[3] == pytest.approx([0, 3, 2])
    assert logits[4] is None
    assert logits[5] == pytest.approx([2, 0.3, 0])  # the model's own limit of four tokens
    scored = score_sentiment(df, "text", onnx, score_mode="prob_diff")
    assert column(scored, "sentence_sentiments_lst")[1][0] > 0


def test_wrong_number_of_classes_is_noticed(spark, onnx):
    onnx.labels = ("LABEL_0", "LABEL_1")
    df = spark.createDataFrame([("good",)], "text string")
    with pytest.raises(Exception, match="the scorer returned"):
        df.select(model_logits(onnx, F.col("text"))).collect()


def test_onnx_settings_are_checked():
    with pytest.raises(ValueError):
        OnnxScorer("m", "t", ("a",), batch_size=0)


def test_map_labels_by_join(spark):
    rows = spark.createDataFrame([("RoBERTa", "LABEL_0"), ("bert", "4 stars"), ("bert", "odd")], "m string, r string")
    entries = [(m, r, x) for m, e in S.LABEL_MAP.items() for r, x in e.items()]
    table = spark.createDataFrame(entries, "model string, raw_label string, label string")
    assert column(map_labels(rows, table, "m", "r"), "label", "r") == {"LABEL_0": "NEGATIVE", "4 stars": "POSITIVE", "odd": "odd"}


def test_ensemble_ignores_null_scores(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0), (2, None, 0.5), (3, None, None)], "id bigint, a double, b double")
    assert column(ensemble_score(df, ["a", "b"]), "ensemble_score") == {1: 0.5, 2: 0.5, 3: None}


def test_analyzer_and_run_records(spark, reviews):
    path = shared_path(spark, "runs")
    analyzer = SentimentAnalyzer(
        spark, scorers={"vader": LEXICON, "roberta": MARKS}, run_log_path=path, materialise_result=True
    )
    by_sentence = analyzer.trigger_SentimentInference(reviews, "VADER", "reviews", repartition=True, key_columns=["id"])
    assert by_sentence.count() == 3
    by_document = analyzer.trigger_SentimentInference(reviews, "roberta", "reviews", sentParse=False)
    assert "doc_sentiments" in by_document.columns
    for wrong in ("unheard-of", "bert"):
        with pytest.raises(ValueError):
            analyzer.trigger_SentimentInference(reviews, wrong, "reviews")
    runs = read_runs(spark, path).orderBy("started_at").collect()
    assert [run.success for run in runs] == [1.0, 1.0, 0.0, 0.0]
    assert runs[0].metrics == {"rows": 3.0} and "unheard-of" in runs[2].error
    assert runs[0].parameters["sentParse"] == "True" and runs[0].run_date is not None
    with pytest.raises(ValueError):
        SentimentAnalyzer(spark, transformer_batch_size=0)


def test_regroup_keeps_order_and_empty_documents(spark, holes):
    rows = O.explode_sentences(holes, ["id"], "text").repartition(5, "pos")
    got = column(O.regroup_sentences(holes, rows, ["id"], "sentence", "again"), "again")
    assert got == {1: [], 2: [], 3: ["good.", "bad."], 4: []}


def test_repartition_rule(spark):
    df = spark.range(1000).repartition(4)
    assert O.wanted_partitions(250_000) == 4
    assert O.repartition_by_rows(df, rows_per_partition=100, rows=1000).rdd.getNumPartitions() == 12
    fewer = O.repartition_by_rows(df.repartition(20), rows_per_partition=500, rows=1000, checkpoint=True)
    assert fewer.rdd.getNumPartitions() == 4 and fewer.count() == 1000
    assert O.repartition_by_rows(df).count() == 1000
    with pytest.raises(ValueError):
        O.repartition_by_rows(df, rows_per_partition=0)


def test_csv(spark, tmp_path):
    (tmp_path / "p.csv").write_text('Product,Category\n"a, ""b""",x\nc,\n,""\n')
    df = read_csv(spark, str(tmp_path / "p.csv"), string_schema(["Product", "Category"]))
    assert [tuple(row) for row in df.collect()] == [('a, "b"', "x"), ("c", None), (None, None)]


def test_materialise_cuts_lineage(spark, reviews):
    stored = materialise(score_sentiment(reviews, "reviews", LEXICON))
    assert stored.schema.names == ["id", "reviews", "sentences_array", "sentence_sentiments_lst"]
    assert stored.count() == 3 and stored.inputFiles()


def test_written_tables_can_be_removed(spark, reviews, monkeypatch):
    from textlens import session

    monkeypatch.setattr(session, "_WRITTEN", {})
    stored = materialise(reviews)
    folder = stored.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
    assert os.path.isdir(folder) and shared_path(spark, "unused")
    assert session.remove_written(spark) == 1 and not os.path.exists(folder)
    assert session.remove_written(spark) == 0


def test_stream_equals_batch(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    folder = shared_path(spark, "stream-in")
    docs.repartition(6, "doc_id").write.parquet(folder)
    sink, log = shared_path(spark, "stream-out"), shared_path(spark, "stream-log")

    def score(df):
        return score_sentiment(df, "text", MARKS).select("doc_id", "sentence_sentiments_lst")

    stream = read_stream(spark, folder, docs.schema, max_files_per_trigger=2)
    score_stream(stream, score, sink, log).awaitTermination()
    streamed = spark.read.parquet(sink)
    assert streamed.exceptAll(score(docs)).count() == 0 and streamed.count() == docs.count()


# Lexicon tables: in the plan, sent to the tasks, joined ------------------------------------------

WAYS = {"plan": {}, "sent": {"max_inline": 0}, "joined": {"max_inline": 0, "max_sent": 0}}
TEXTS = [
    (1, "Not good at all. Very good! It is GOOD?"), (1, "Not good at all. Very good! It is GOOD?"), (None, None), (None, "good"), (2, ""), (3, "  "),
    (4, "no good, but kind of bad; never so good"), (5, "the cat sat. the bad cat sat on the bad cat. cat sat on"), (6, "\x00 good\x1fbad É" + " good" * 500),
]


def by_every_way(spark, entries, level, **options):
    df = spark.createDataFrame(TEXTS, "id bigint, text string").repartition(3)
    table = spark.createDataFrame(entries, "token string, valence double")
    name = "doc_sentiments" if level == "document" else "sentence_sentiments_lst"
    found = {}
    for way, limits in WAYS.items():
        rows = score_sentiment(df, "text", table, level=level, **limits, **options).collect()
        found[way] = sorted(((r["id"], r["text"], r[name]) for r in rows), key=str)
    return found


ENTRIES = [("good", 1.9), ("Good", 1.5), ("bad", -2.5), ("cat", 0.3), (None, 5.0), ("sat", None)] + [(f"none{k}", 1.0) for k in range(300)]


@pytest.mark.parametrize("level", ["document", "sentence"])
def test_rules_at_every_size_of_lexicon(spark, level):
    found = by_every_way(spark, ENTRIES, level, rules=Rules())
    assert found["plan"] == found["sent"] == found["joined"] and len(found["plan"]) == len(TEXTS)
    inline = RuleLexicon({"good": 1.9, "bad": -2.5, "cat": 0.3})
    df = spark.createDataFrame(TEXTS, "id bigint, text string")
    name = "doc_sentiments" if level == "document" else "sentence_sentiments_lst"
    rows = score_sentiment(df, "text", inline, level=level).collect()
    assert found["joined"] == sorted(((r["id"], r["text"], r[name]) for r in rows), key=str)


def test_not_good_is_negative_by_table(spark):
    df = spark.createDataFrame([(1, "this is not good")], "id bigint, text string")
    table = spark.createDataFrame([("good", 1.9)], "token string, valence double")
    plain = score_sentiment(df, "text", table, level="document", max_inline=0).first()["doc_sentiments"]
    ruled = score_sentiment(df, "text", table, level="document", max_inline=0, rules=Rules()).first()["doc_sentiments"]
    assert plain == 0.4404 and ruled == pytest.approx(-0.3412, abs=1e-3)
    analyzer = SentimentAnalyzer(spark, scorers={"vader": table})
    assert analyzer.trigger_SentimentInference(df, "vader", sentParse=False).first()["doc_sentiments"] == ruled


PHRASES = {"the cat": 1.0, "cat": -1.0, "cat sat on": 2.0, "sat on the": -3.0, "the": 0.25, "on": 0.5, "bad  Cat": 0.125}


def longest_first(text, phrases):
    words = [w.strip(".,;?!").lower() for w in text.split()]
    entries, total, k = {" ".join(p.lower().split()): v for p, v in phrases.items()}, 0.0, 0
    while k < len(words):
        for n in range(3, 0, -1):
            run = " ".join(words[k : k + n])
            if k + n <= len(words) and run in entries:
                total, k = total + entries[run], k + n
                break
        else:
            k += 1
    return total


def test_phrases_longest_first(spark):
    texts = ["the cat sat on the cat", "cat sat on the bad cat", "Sat on the cat, cat sat on", "the the cat", "on", "", "zzz", "bad cat bad"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    sums = PhraseLexicon(PHRASES).valence_sum(F.col("text"))
    for r in df.withColumn("x", sums).collect():
        assert r["x"] == pytest.approx(longest_first(r["text"], PHRASES)), r["text"]
    found = by_every_way(spark, list(PHRASES.items()), "sentence", phrases=True)
    assert found["plan"] == found["sent"] == found["joined"]
    five = next(r[2] for r in found["sent"] if r[0] == 5)
    wanted = [longest_first(s, PHRASES) for s in ("the cat sat.", "the bad cat sat on the bad cat.", "cat sat on")]
    assert five == [pytest.approx(x / (x * x + 15) ** 0.5, abs=1e-4) for x in wanted]


def test_filter_lets_hits_through_and_little_else(spark):
    from textlens.operators.lexicon_values import bloom_filter, may_contain, normalised, sifted

    table = spark.range(3000).selectExpr("concat('word', id) AS token", "1D AS valence")
    entries = normalised(table)
    words = spark.range(40_000).selectExpr("concat('word', id) AS key").selectExpr("key", "xxhash64(key) AS h").toPandas()
    passed = may_contain(bloom_filter(entries, 3000), words["h"].to_numpy())
    assert passed[:3000].all() and passed[3000:].mean() < 0.01
    rows = spark.range(200).selectExpr("id AS _row", "array(transform(sequence(0, 99), k -> concat('word', id * 100 + k))) AS keys")
    kept = sifted(rows, F.col("keys"), "_row", entries, 3000)
    assert 3000 <= kept.count() <= 3000 + 0.01 * 17_000
    assert kept.where("key <> concat('word', _row * 100 + place)").count() == 0


def test_frequent_words_are_dealt_out(spark, monkeypatch):
    from textlens.operators import lexicon_values as V

    monkeypatch.setattr(V, "FREQUENT", 3)
    monkeypatch.setattr(V, "SAMPLED_ROWS", 1)
    found = by_every_way(spark, ENTRIES, "document", rules=Rules())
    assert found["joined"] == found["plan"]


def test_valences_must_be_finite_at_every_size(spark):
    table = spark.createDataFrame([("good", float("nan"))], "token string, valence double")
    df = spark.createDataFrame([(1, "good")], "id int, text string")
    for limits in WAYS.values():
        with pytest.raises(Exception, match="finite"):
            score_sentiment(df, "text", table, level="document", **limits).collect()


def test_options_of_tables_only(reviews):
    for options in ({"rules": Rules()}, {"phrases": True}):
        with pytest.raises(ValueError):
            score_sentiment(reviews, "reviews", LEXICON, **options)
