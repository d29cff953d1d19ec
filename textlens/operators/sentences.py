"""Sentences as rows and back, and partition sizing."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F

from textlens.functions.text import SENTENCE_BOUNDARY, sentences
from textlens.session import ensure_checkpoint_dir

SENTENCES_COLUMN = "sentences_array"
SENTENCE_SCORES_COLUMN = "sentence_sentiments_lst"
DOC_SCORE_COLUMN = "doc_sentiments"

ROWS_PER_PARTITION = 100_000


def add_sentences(df: DataFrame, text: str, boundary: str = SENTENCE_BOUNDARY) -> DataFrame:
    return df.withColumn(SENTENCES_COLUMN, sentences(text, boundary))


def add_sentence_count(df: DataFrame, array: str = SENTENCES_COLUMN) -> DataFrame:
    """Sentences per row; null text has a null count."""
    counted = F.when(F.col(array).isNotNull(), F.size(array)).cast("bigint")
    return df.withColumn("sentence_count", counted)


def explode_sentences(
    df: DataFrame, keys: Sequence[str], text: str, boundary: str = SENTENCE_BOUNDARY
) -> DataFrame:
    """One row per sentence: keys, ``pos`` (from 0), ``sentence``.

    Rows are produced where the document lies. Documents without sentences produce none; the
    left join in ``regroup_sentences`` brings them back.
    """
    return df.select(*keys, F.posexplode(sentences(text, boundary)).alias("pos", "sentence"))


def sentence_rows(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A sentence-scored table as one row per sentence: keys, ``pos``, ``sentence``, ``score``.

    Explodes an expression over the arrays. Exploding the array columns themselves would make the
    optimizer infer a filter on them and so compute the scores again for it.
    """
    pairs = F.arrays_zip(SENTENCES_COLUMN, SENTENCE_SCORES_COLUMN)
    rows = scored.select(*keys, F.posexplode(pairs).alias("pos", "_s"))
    return rows.select(
        *keys, F.col("pos").cast("bigint").alias("pos"),
        F.col(f"_s.{SENTENCES_COLUMN}").alias("sentence"), F.col(f"_s.{SENTENCE_SCORES_COLUMN}").alias("score"),
    )


def regroup_sentences(
    df: DataFrame, values: DataFrame, keys: Sequence[str], value: str, out: str
) -> DataFrame:
    """Collect ``value`` per key in sentence order and append it to ``df`` as an array.

    ``keys`` must identify a document, so a group is never larger than the sentences of one
    source row; null is a key like any other. A position that occurs twice under a key fails the job, because the rows of two
    documents can't be told apart then. Only key, position and value are shuffled for the grouping. A key without rows in
    ``values`` receives an empty array.
    """
    ordered = F.array_sort(F.collect_list(F.struct("pos", F.col(value).alias("value"))))
    arrays = values.groupBy(*keys).agg(ordered.alias("_pairs"))
    repeated = F.size(F.array_distinct("_pairs.pos")) < F.size("_pairs")
    message = F.lit(f"the keys {list(keys)} do not identify a document: a position occurs twice")
    found = F.when(repeated, F.raise_error(message)).otherwise(F.col("_pairs.value"))
    arrays = arrays.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], found.alias("_found"))
    element = values.schema[value].dataType.simpleString()
    empty = F.array().cast(f"array<{element}>")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    # Both sides have a row per document, so neither is ever worth a broadcast.
    joined = df.join(arrays.hint("merge"), same, "left").withColumn(out, F.coalesce("_found", empty))
    return joined.drop("_found", *[f"_key{i}" for i in range(len(keys))])


def spread(df: DataFrame, keys: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Give an input of fewer files than cores one partition per core, by hash of ``keys``.

    A small file arrives as one task whatever the cluster. An input of at least as many files
    as cores comes back untouched, so nothing is shuffled at scale. Files are listed, no job runs.
    """
    wanted = partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted, *keys) if len(df.inputFiles()) < wanted else df


def wanted_partitions(rows: int, rows_per_partition: int = ROWS_PER_PARTITION) -> int:
    return 2 + rows // rows_per_partition


def repartition_by_rows(
    df: DataFrame,
    keys: Sequence[str] = (),
    rows_per_partition: int = ROWS_PER_PARTITION,
    rows: int | None = None,
    checkpoint: bool = False,
) -> DataFrame:
    """Size partitions: by ``n = 2 + rows // rows_per_partition`` for a caller who knows the number of rows.

    Without ``rows`` nothing is counted: Spark sizes the partitions by bytes while the query runs
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), splitting skewed ones and merging small ones; no job runs here.
    Pass unique ``keys`` to spread counted rows by hash: that placement is the same when a lost task runs again.
    """
    if rows_per_partition <= 0:
        raise ValueError("rows_per_partition must be positive")
    if rows is None:
        df = df.hint("rebalance")
    else:
        df = df.repartition(wanted_partitions(rows, rows_per_partition), *keys)
    if checkpoint:
        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint()
    return df
