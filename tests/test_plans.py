"""What the physical plans may and may not contain."""

import io
from contextlib import redirect_stdout

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from textlens import Lexicon, MarkerScorer, score_sentiment
from textlens.functions import text as X
from textlens.functions.scores import binarize
from textlens.operators.sentences import sentence_rows, spread
from textlens.operators.split import fit_split

LEXICON = Lexicon({"the": 0.5, "of": -0.5, "and": 1.0})
MODEL = MarkerScorer({"LABEL_0": ("of",), "LABEL_1": ("the",), "LABEL_2": ("and",)})


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.fixture
def docs(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet")


@pytest.mark.parametrize("level", ["sentence", "document"])
@pytest.mark.parametrize("scorer", [LEXICON, MODEL], ids=["lexicon", "model"])
def test_in_place_scoring_does_not_shuffle(docs, scorer, level):
    text = plan(score_sentiment(docs, "text", scorer, level=level))
    assert "Exchange" not in text and "Join" not in text
    assert ("Python" in text or "ArrowEval" in text) == (scorer is MODEL)


def test_pruning_and_pushdown_through_scoring(docs):
    scored = score_sentiment(docs, "text", MODEL, level="document").where("lang = 'en'").select("doc_id", "doc_sentiments")
    text = plan(scored)
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in text
    assert "source" not in text.split("ReadSchema")[1].splitlines()[0]


def test_unused_plain_scores_are_not_computed(docs):
    scored = score_sentiment(docs, "text", MODEL, level="document", once=False)
    assert "Arrow" not in plan(scored.select("doc_id"))


@pytest.mark.parametrize("level", ["sentence", "document"])
def test_a_filter_on_scores_does_not_run_the_model_again(docs, level):
    name = "doc_sentiments" if level == "document" else "sentence_sentiments_lst"
    positive = "doc_sentiments > 0.1" if level == "document" else "sentence_sentiments_lst[0] > 0.1"
    scored = score_sentiment(docs, "text", MODEL, level=level, score_mode="prob_diff")
    text = plan(scored.where(positive).where("lang = 'en'").select("doc_id", name))
    assert text.count("+- ArrowEvalPython") == 1 and "EqualTo(lang,en)" in text


@pytest.mark.parametrize("level", ["sentence", "document"])
def test_a_filter_on_lexicon_scores_does_not_score_again(docs, level):
    scored = score_sentiment(docs, "text", LEXICON, level=level)
    positive = F.col("doc_sentiments") > 0 if level == "document" else F.size("sentence_sentiments_lst") > 3
    text = plan(scored.where(positive).select("doc_id"))
    assert text.count("regexp_extract_all") == plan(scored.select("doc_id")).count("regexp_extract_all")


def test_sentence_rows_score_each_sentence_once(docs):
    text = plan(sentence_rows(score_sentiment(docs, "text", LEXICON), ["doc_id"]))
    assert "Filter" not in text


def test_only_small_inputs_are_spread(spark, docs, tmp_path):
    assert spread(docs, ["doc_id"]).rdd.getNumPartitions() == 4
    docs.repartition(9).write.parquet(str(tmp_path / "many"))
    many = spark.read.parquet(str(tmp_path / "many"))
    assert spread(many, ["doc_id"]) is many


def test_split_assignment_moves_no_rows(docs):
    text = plan(fit_split(docs, "doc_id", "lang").assign(docs))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


TEXTS = st.text(alphabet=st.sampled_from("ab .!?\n\tThe of,and'é"), max_size=60)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(TEXTS, min_size=1, max_size=20))
def test_sentence_and_score_properties(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, text string")
    rows = score_sentiment(df, "text", LEXICON).withColumn(
        "signs", F.transform("sentence_sentiments_lst", lambda x: binarize(x))
    ).withColumn("rejoined", F.array_join(X.sentences("text"), " ")).collect()
    for row in rows:
        assert len(row.sentences_array) == len(row.sentence_sentiments_lst)
        assert all(-1 <= s <= 1 for s in row.sentence_sentiments_lst)
        assert set(row.signs) <= {-1.0, 0.0, 1.0}
        assert row.rejoined.split() == row.text.split()
