"""Exact stratified train / validation / test split that no hot class can slow down.

Rows of a class are ordered by ``md5(seed:key)``. The first ``round(share * n)`` go to test, the
next ``round(share * rest)`` to validation, the others to train. Ranking a whole class would need
all its rows in one task, so only the two cut points of a class are looked for:

1. count rows per (class, first hash digits): few buckets, so map-side combine leaves a few hundred
   rows per class and task whatever the input;
2. running counts of a class over its buckets tell in which bucket each cut falls;
3. while such a bucket is large, count inside it again by further digits - each pass looks at
   1/256 of the rows before;
4. rank the rows of the buckets that remain to find the row at the cut;
5. every row compares itself with the two cuts of its class.

All passes read key and label only and end in one row per class. Step 5 is lazy and moves no rows
while the classes are few enough for a broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from textlens.operators.labels import MAX_LOCAL_CLASSES
from textlens.operators.small_tables import broadcast_if_small
from textlens.session import ensure_checkpoint_dir

SEED = 42
HOLDOUT = 0.1
HASH_DIGITS = 32
# Sorts behind every row of a hash: the character after the separator of hash and key.
AFTER_HASH = ";"
DIGITS_PER_PASS = 2
# A bucket of up to this many rows is ranked by one task.
RANKED_ROWS = 1_000_000


def hash_order(key: Column, seed: int) -> Column:
    """Sort position of a row: hash first, key second, so that it is unique and total."""
    key = key.cast("string")
    return F.concat(F.md5(F.concat(F.lit(f"{seed}:"), key)), F.lit(":"), key)


def _settled(table: DataFrame, max_local: int) -> tuple[DataFrame, int]:
    """A table of class size, computed once: a broadcast one if it is small, a stored one if not.

    Also returns the largest bucket it names, if it names any.
    """
    settled = broadcast_if_small(table, max_local)
    if settled is None:
        ensure_checkpoint_dir(table.sparkSession)
        settled = table.checkpoint()
    largest = settled.agg(F.max("_rows")).first()[0] if "_rows" in table.columns else 0
    return settled, largest or 0


def _prefix(digits: int) -> Column:
    return F.substring("_order", 1, digits)


def _cut_buckets(counted: DataFrame) -> DataFrame:
    """Buckets that hold a cut. Input: class, bucket, rows, rows up to here, and the two cuts."""
    before = F.col("_upto") - F.col("_rows")

    def here(cut: str) -> Column:
        return (F.col(cut) > before) & (F.col(cut) <= F.col("_upto"))

    return counted.where(here("_test") | here("_last")).select(
        "_label", "_bucket", "_rows", before.alias("_before"), "_test", "_last"
    )


def _first_pass(rows: DataFrame, holdout: float, digits: int) -> DataFrame:
    buckets = rows.groupBy("_label", _prefix(digits).alias("_bucket")).agg(F.count("*").alias("_rows"))
    of_class = Window.partitionBy("_label")
    upto = of_class.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = buckets.select(
        "*", F.sum("_rows").over(upto).alias("_upto"), F.sum("_rows").over(of_class).alias("_n")
    )

    def share(n: Column) -> Column:
        return F.when(F.col("_n") < 2, 0).otherwise(F.round(n * holdout)).cast("bigint")

    counted = counted.withColumn("_test", share(F.col("_n")))
    counted = counted.withColumn("_last", F.col("_test") + share(F.col("_n") - F.col("_test")))
    return _cut_buckets(counted)


def _inside(rows: DataFrame, cuts: DataFrame, digits: int) -> DataFrame:
    """Rows of the buckets named by ``cuts``, with the columns of ``cuts``."""
    named = cuts.select(F.col("_label").alias("_l"), F.col("_bucket").alias("_outer"), "_before", "_test", "_last")
    same = (F.col("_label") == F.col("_l")) & (_prefix(digits) == F.col("_outer"))
    return rows.join(named, same).drop("_l")


def _next_pass(rows: DataFrame, cuts: DataFrame, known: int, digits: int) -> DataFrame:
    keys = ["_label", "_outer", "_before", "_test", "_last"]
    inner = _inside(rows, cuts, known).groupBy(*keys, _prefix(digits).alias("_bucket"))
    buckets = inner.agg(F.count("*").alias("_rows"))
    upto = Window.partitionBy("_label", "_outer").orderBy("_bucket")
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _cut_buckets(buckets.withColumn("_upto", F.col("_before") + F.sum("_rows").over(upto)))


@dataclass(frozen=True)
class SplitCuts:
    """Cut points per class; ``assign`` labels the rows of any table with the same key and label."""

    table: DataFrame
    key: str
    label: str
    seed: int

    def assign(self, df: DataFrame, out: str = "split") -> DataFrame:
        order = hash_order(F.col(self.key), self.seed)
        joined = df.join(self.table, F.col(self.label) == F.col("_cut_label"), "left")
        part = (
            F.when(order <= F.col("_test_cut"), "test")
            .when(order <= F.col("_last_cut"), "validation")
            .otherwise("train")
        )
        return joined.withColumn(out, part).drop("_cut_label", "_test_cut", "_last_cut")


def fit_split(
    df: DataFrame,
    key: str,
    label: str,
    holdout: float = HOLDOUT,
    seed: int = SEED,
    digits_per_pass: int = DIGITS_PER_PASS,
    ranked_rows: int = RANKED_ROWS,
    max_local: int = MAX_LOCAL_CLASSES,
) -> SplitCuts:
    """Find the cut points. Counts are exact when ``key`` is unique; equal keys stay together
    wherever more than ``ranked_rows`` of them meet a cut.
    """
    if not 0 < holdout < 1:
        raise ValueError("holdout must lie between 0 and 1")
    if not 0 < digits_per_pass <= HASH_DIGITS:
        raise ValueError(f"digits_per_pass must lie between 1 and {HASH_DIGITS}")
    rows = df.select(F.col(label).alias("_label"), hash_order(F.col(key), seed).alias("_order"))
    rows = rows.where("_label is not null")

    known = digits_per_pass
    cuts, largest = _settled(_first_pass(rows, holdout, known), 2 * max_local)
    while largest > ranked_rows and known < HASH_DIGITS:
        digits = min(known + digits_per_pass, HASH_DIGITS)
        cuts, largest = _settled(_next_pass(rows, cuts, known, digits), 2 * max_local)
        known = digits

    if largest > ranked_rows:
        # One hash, many rows: a repeated key. Its rows stay together, on the side of the cut.
        def end(cut: str) -> Column:
            holds = (F.col(cut) > F.col("_before")) & (F.col(cut) <= F.col("_before") + F.col("_rows"))
            return F.max(F.when(holds, F.concat("_bucket", F.lit(AFTER_HASH))))

        at_cut = cuts.groupBy(F.col("_label").alias("_cut_label")).agg(
            end("_test").alias("_test_cut"), end("_last").alias("_last_cut")
        )
        return SplitCuts(_settled(at_cut, max_local)[0], key, label, seed)

    in_bucket = Window.partitionBy("_label", "_outer").orderBy("_order")
    ranked = _inside(rows, cuts, known).withColumn("_rank", F.col("_before") + F.row_number().over(in_bucket))
    ranked = ranked.where((F.col("_rank") == F.col("_test")) | (F.col("_rank") == F.col("_last")))
    at_cut = ranked.groupBy(F.col("_label").alias("_cut_label")).agg(
        F.max(F.when(F.col("_rank") == F.col("_test"), F.col("_order"))).alias("_test_cut"),
        F.max(F.when(F.col("_rank") == F.col("_last"), F.col("_order"))).alias("_last_cut"),
    )
    return SplitCuts(_settled(at_cut, max_local)[0], key, label, seed)


def stratified_split(df: DataFrame, key: str, label: str, out: str = "split", **options) -> DataFrame:
    """Append ``train`` / ``validation`` / ``test``: exact counts per class, the same in every run.

    Classes with fewer than two rows stay in train, as do rows whose label is null.
    """
    return fit_split(df, key, label, **options).assign(df, out)
