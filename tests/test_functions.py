"""Column builders on hand-written cases."""

import math

import pytest
from pyspark.sql import functions as F

from textlens import Lexicon
from textlens.functions import scores as S
from textlens.functions import text as X
from textlens.functions.lexicon_rules import RuleLexicon, Rules
from textlens.operators.sentences import add_sentence_count, add_sentences


def values(spark, rows, schema, column):
    return [row[0] for row in spark.createDataFrame(rows, schema).select(column).collect()]


def test_sentences_of_null_empty_blank_and_marked_text(spark):
    rows = [(None,), ("",), ("  \n ",), ("Hi. Yo!! ok",), (" a.b 1.5? c",), ("one",)]
    got = values(spark, rows, "t string", X.sentences("t"))
    assert got == [None, [], [], ["Hi.", "Yo!!", "ok"], ["a.b 1.5?", "c"], ["one"]]


def test_sentence_boundary_is_a_parameter(spark):
    got = values(spark, [("a b; c ;d",)], "t string", X.sentences("t", boundary=";"))
    assert got == [["a b", "c", "d"]]


def test_control_characters_in_text_are_not_boundaries(spark):
    got = values(spark, [("a\x01b. c",)], "t string", X.sentences("t"))
    assert got == [["a\x01b.", "c"]]


def test_sentence_count(spark):
    df = spark.createDataFrame([(None,), ("",), ("A. B.",)], "t string")
    got = add_sentence_count(add_sentences(df, "t")).select("sentence_count").collect()
    assert [row[0] for row in got] == [None, 0, 2]


def test_concat_skips_nulls_and_keeps_empty(spark):
    rows = [(None, "b"), ("", "b"), (None, None), ("a", "b")]
    assert values(spark, rows, "x string, y string", X.concat_text("x", "y")) == ["b", " . b", "", "a . b"]


def test_placeholder_comes_before_joining(spark):
    rows = [(None, "", 3), ("a", "b", None)]
    schema = "x string, y string, z int"
    assert values(spark, rows, schema, X.composite_label("x", "y", "z")) == ["None|||None|||3", "a|||b|||None"]
    assert values(spark, rows, schema, X.input_text("x", "y", "z")) == ["None None 3", "a b None"]


def test_truncation(spark):
    rows = [(None,), ("",), (" a  b\nc d ",), ("a",)]
    assert values(spark, rows, "t string", X.truncate_tokens("t", 2)) == [None, "", "a b", "a"]
    with pytest.raises(ValueError):
        X.truncate_tokens("t", 0)


def test_binarize(spark):
    rows = [(0.3,), (-0.2,), (0.0,), (math.nan,), (None,)]
    assert values(spark, rows, "x double", S.binarize(F.col("x"))) == [1.0, -1.0, 0.0, 0.0, None]


def test_signed_polarity_and_the_neutral_quirk(spark):
    rows = [("NEGATIVE", 0.9), ("NEUTRAL", 0.4), ("neutral", 0.5), ("POSITIVE", 0.8), ("other", 0.7),
            ("very negative", 0.6), ("NEUTRAL", 0.6)]
    column = S.signed_polarity(F.col("l"), F.col("c"))
    got = values(spark, rows, "l string, c double", column)
    assert got == pytest.approx([-0.9, -0.1, 0.0, 0.8, 0.7, -0.6, 0.1])
    signs = values(spark, rows, "l string, c double", S.binarize(column))
    assert signs == [-1.0, -1.0, 0.0, 1.0, 1.0, -1.0, 1.0]


def test_label_mapping_passes_unknown_labels_and_ignores_model_case(spark):
    rows = [("LABEL_0",), ("LABEL_2",), ("joy",), (None,)]
    assert values(spark, rows, "l string", S.canonical_label("RoBERTa", F.col("l"))) == ["NEGATIVE", "POSITIVE", "joy", None]
    assert values(spark, [("3 stars",)], "l string", S.canonical_label("bert", F.col("l"))) == ["NEUTRAL"]
    with pytest.raises(ValueError):
        S.canonical_label("unheard-of", F.col("l"))


@pytest.mark.parametrize("classes", [3, None])
def test_softmax_does_not_overflow(spark, classes):
    rows = [([1.0, 2.0, 3.0],), ([1000.0, 1000.0, -1000.0],), (None,)]
    got = values(spark, rows, "l array<double>", S.softmax(F.col("l"), classes))
    assert got[0] == pytest.approx([0.09003057, 0.24472847, 0.66524096])
    assert got[1] == pytest.approx([0.5, 0.5, 0.0])
    assert got[2] is None


def test_argmax_takes_the_first_of_a_tie(spark):
    rows = [([0.2, 0.4, 0.4],), ([1.0, 0.0, 0.0],), (None,)]
    assert values(spark, rows, "p array<double>", S.argmax(F.col("p"))) == [1, 0, None]


def test_polarity_difference_ignores_neutral(spark):
    rows = [([0.2, 0.5, 0.3],)]
    assert values(spark, rows, "p array<double>", S.polarity_difference(F.col("p"))) == pytest.approx([0.1])


def test_percent_text(spark):
    rows = [(0.85,), (1.0,), (0.095,), (None,), (0.33333,)]
    assert values(spark, rows, "x double", S.percent_text(F.col("x"))) == ["85.0%", "100.0%", "9.5%", None, "33.33%"]


def test_lexicon_scores(spark):
    lexicon = Lexicon({"Good": 2.0, "bad": -3.0, "l'eau": 1.0, "été": 0.5})
    rows = [("good, BAD!",), ("nothing here",), ("",), (None,), ("(L'eau) Été good.",)]
    got = values(spark, rows, "t string", lexicon.score(F.col("t")))
    expected = [-1 / math.sqrt(16), 0.0, 0.0, None, 3.5 / math.sqrt(3.5**2 + 15)]
    assert [None if v is None else round(v, 4) for v in expected] == got


def test_lexicon_of_many_buckets_finds_every_entry(spark):
    entries = {f"w{i}é": i / 7 for i in range(3000)}
    lexicon = Lexicon(entries)
    df = spark.createDataFrame(list(entries.items()), "t string, v double")
    assert df.where(~F.equal_null(lexicon.valence(F.col("t")), F.col("v"))).count() == 0
    assert df.where(lexicon.valence(F.concat("t", F.lit("x"))).isNotNull()).count() == 0


def test_lexicon_limits():
    with pytest.raises(ValueError):
        Lexicon({"a": 1.0, "b": 1.0}, max_entries=1)
    with pytest.raises(ValueError):
        Lexicon({"a": math.nan})


def test_lexicon_from_table(spark):
    table = spark.createDataFrame([("A", 1.0), ("a", 2.0), ("b", None), (None, 1.0)], "token string, valence double")
    assert Lexicon.from_table(table).entries == {"a": 2.0}
    assert Lexicon.from_table(table, max_entries=2) is None


WORDS = {"smart": 1.7, "handsome": 2.2, "funny": 1.9, "good": 1.9, "bad": -2.5, "love": 3.2, "worst": -3.1,
         "best": 3.2, "no": -1.2, "great": 3.1, "terrible": -2.1}
# Scores of these texts as published with the rules.
PUBLISHED = [
    ("VADER is smart, handsome, and funny.", 0.8316),
    ("VADER is smart, handsome, and funny!", 0.8439),
    ("VADER is very smart, handsome, and funny.", 0.8545),
    ("VADER is VERY SMART, handsome, and FUNNY.", 0.9227),
    ("VADER is VERY SMART, handsome, and FUNNY!!!", 0.9342),
    ("VADER is not smart, handsome, nor funny.", -0.7424),
    ("The book was good.", 0.4404),
    ("The book was only kind of good.", 0.3832),
    ("Not bad at all", 0.431),
]


def test_published_rule_scores(spark):
    rows = PUBLISHED + [("", 0.0), (None, None)]
    got = values(spark, rows, "t string, s double", RuleLexicon(WORDS).score(F.col("t")))
    assert got == [score for _, score in rows]


def test_capitals_mean_nothing_in_a_text_of_capitals(spark):
    rows = [("VERY GOOD BOOK",), ("VERY GOOD book",), ("GOOD 1 BOOK",)]
    got = values(spark, rows, "t string", RuleLexicon(WORDS).valence_sum(F.col("t")))
    assert got == pytest.approx([1.9 + 0.293, 1.9 + 0.733 + 0.293 + 0.733, 1.9 + 0.733])


def test_rules_contrast_and_refusal(spark):
    plain = RuleLexicon(WORDS, Rules(contrast="however"))
    got = values(spark, [("good but bad",)], "t string", plain.valence_sum(F.col("t")))
    assert got == pytest.approx([1.9 - 2.5])
    turned = values(spark, [("good but bad",)], "t string", RuleLexicon(WORDS).valence_sum(F.col("t")))
    assert turned == pytest.approx([1.9 * 0.5 - 2.5 * 1.5])
    refused = values(spark, [("no good",), ("at least good",), ("the least good",)], "t string",
                     RuleLexicon(WORDS).valence_sum(F.col("t")))
    assert refused == pytest.approx([1.9 * -0.74, 1.9, 1.9 * -0.74])
