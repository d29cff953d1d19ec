"""Spark-native sentiment scoring and text classification.

Everything is a function from DataFrame (or Column) to DataFrame (or Column); plans stay lazy until
the caller runs an action, except where a step is a fit, a save or a run record.
"""

from textlens.plans.classify import TextClassifier
from textlens.plans.sentiment import SentimentAnalyzer, score_sentiment
from textlens.functions.lexicon import Lexicon, PhraseLexicon
from textlens.functions.lexicon_rules import RuleLexicon, Rules
from textlens.scorers import MarkerScorer, OnnxScorer, Scorer

__all__ = [
    "Lexicon",
    "MarkerScorer",
    "OnnxScorer",
    "PhraseLexicon",
    "RuleLexicon",
    "Rules",
    "Scorer",
    "SentimentAnalyzer",
    "TextClassifier",
    "score_sentiment",
]
