"""Byte-level BPE encoding and decoding.

A text is cut by the tokenizer's pattern; every piece is a word. A word is encoded by a fold over its bytes with
Spark's higher-order functions: find the adjacent pair of lowest rank, the leftmost of equals, merge it, until no
pair has a rank. Ranks are a literal map of the plan. Bytes are held as hexadecimal text, which concatenates like
the bytes do.

The most frequent distinct words, counted over all documents, are folded once in this way: those that occur as often as the
smallest count for which they are no more than ``FREQUENT``, found from a histogram of counts. Texts
are then encoded in Arrow batches, a lookup for each word; the rarer words, a few in a hundred, and words of more than
``FOLDED_BYTES`` bytes are merged where they stand by the same rule (``merge_word``, ``merge_long``). Folding those with
higher-order functions as well (``encode_column``) gives the same ids, but costs about three times the time limit. Texts are
never shuffled; only words and counts are, combined before the shuffle. Tasks pack the folded words; the driver passes
the packed table on, bounded by ``FREQUENT`` words of ``FOLDED_BYTES``, and never opens it.

Decoding looks up the bytes of each id and concatenates them. Defined results: null text is empty and has
no ids; an unknown id decodes to nothing. Other columns are kept, added ones replace columns of the same name.
Of equal pairs the leftmost merges first. A piece of any length is encoded, in time that grows a little faster than its length.
Rows are encoded one by one, so repeated rows need no rule; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Mapping
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from textlens.functions.lexicon import InPlanTable
from textlens.functions.scores import let
from textlens.llm.near_dup import saved
from textlens.sources.sinks import materialise

FREQUENT = 200_000
FOLDED_BYTES = 64
# Counts up to this have a place of their own in the histogram, larger ones one for each power of two.
EXACT_COUNTS = 1024
# Further words a task remembers, and rows it returns at once.
CACHED = 200_000
ROWS_AT_ONCE = 500
NO_RANK = 1 << 30


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: base64 token and rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _lookup(table: Column, of: InPlanTable, key: Column) -> Column:
    """Value of a key in the bound literal of an in-plan table."""
    return F.try_element_at(F.get(table, (F.crc32(key.cast("binary")) % of.buckets).cast("int")), key)


class ByteBPE:
    """An encoder for the ranks and the pattern of a public tokenizer."""

    def __init__(self, ranks: Mapping[bytes, int], pattern: str):
        self.ranks = InPlanTable({token.hex().upper(): rank for token, rank in ranks.items()}, "int")
        # (?U): white space and letters are Unicode's, as in the pattern's own engine.
        self.pattern = "(?U)" + pattern
        self.by_bytes, self.plain_pattern = dict(ranks), pattern
        self.frequent: list[bytes] = []

    def words(self, text: Column) -> Column:
        """Hexadecimal words of a text in order."""
        pieces = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(self.pattern), F.lit(0))
        return F.transform(pieces, lambda p: F.hex(p.cast("binary")))

    def fold(self, word: Column, table: Column) -> Column:
        """Ids of one hexadecimal word by ranked merges; ``table`` holds the rank map."""

        def rank(left: Column, right: Column) -> Column:
            return F.when(left.isNotNull() & right.isNotNull(), _lookup(table, self.ranks, F.concat(left, right)))

        def merge(state: Column, k: Column) -> Column:
            # Pair k is merged; only the two ranks beside it are looked up again.
            parts, ranks, n = state["parts"], state["ranks"], F.size(state["parts"])
            none = F.array().cast("array<int>")
            beside = lambda m: F.concat(
                F.slice(ranks, F.lit(1), F.greatest(k - 2, F.lit(0))),
                F.when(k > 1, F.array(rank(F.get(parts, k - 2), m))).otherwise(none),
                F.when(k + 1 < n, F.array(rank(m, F.get(parts, k + 1)))).otherwise(none),
                F.slice(ranks, k + 2, n),
            )
            return let(
                F.concat(F.get(parts, k - 1), F.get(parts, k)),
                lambda m: F.struct(
                    F.concat(F.slice(parts, F.lit(1), k - 1), F.array(m), F.slice(parts, k + 2, n)).alias("parts"),
                    beside(m).alias("ranks"),
                ),
            )

        def step(state: Column, _: Column) -> Column:
            best = F.array_min(state["ranks"])
            position = F.coalesce(F.array_position(state["ranks"], best), F.lit(0)).cast("int")
            return let(position, lambda k: F.when(k == 0, state).otherwise(merge(state, k)))

        start = lambda b: F.struct(
            b.alias("parts"),
            F.transform(F.slice(b, F.lit(1), F.size(b) - 1), lambda p, i: rank(p, F.get(b, i + 1))).alias("ranks"),
        )
        folded = let(
            F.regexp_extract_all(word, F.lit(".."), F.lit(0)),
            lambda b: F.aggregate(F.sequence(F.lit(1), F.size(b)), start(b), step, lambda state: state["parts"]),
        )
        return F.transform(folded, lambda p: _lookup(table, self.ranks, p))

    def with_frequent(self, docs: DataFrame, text: str = "text", most: int = FREQUENT) -> ByteBPE:
        """Fold the ``most`` most frequent words of all texts."""
        pieces = F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(self.pattern), F.lit(0))
        words = docs.select(F.explode(pieces).alias("word")).where(F.octet_length("word") <= FOLDED_BYTES)
        counts = materialise(words.groupBy("word").agg(F.count(F.lit(1)).alias("n")))
        coarse = F.pow(F.lit(2.0), F.floor(F.log2("n"))).cast("bigint")
        place = F.when(F.col("n") <= EXACT_COUNTS, F.col("n")).otherwise(coarse)
        held, least = 0, 1 << 62
        rows = counts.groupBy(place.alias("least")).agg(F.count(F.lit(1)).alias("words")).collect()  # EXACT_COUNTS + 64 at most
        for row in sorted(rows, reverse=True):
            held += row["words"]
            if held > most:
                break
            least = row["least"]
        packed = self.packed(counts.where(F.col("n") >= least)).collect()  # a row for each task
        self.frequent = [bytes(r["packed"]) for r in packed]
        return self

    def packed(self, words: DataFrame) -> DataFrame:
        """The words of each task with their folded ids."""
        # Dealt out by a plan of its own: one that is made anew after a shuffle is printed with the rank map each time, on the driver.
        dealt = saved(words.select("word").hint("rebalance"))
        folded = let(self.ranks.literal(), lambda table: self.word_ids(F.hex(F.col("word").cast("binary")), table))
        return dealt.select("word", folded.alias("ids")).mapInArrow(_pack_words, "packed binary")

    def word_ids(self, word: Column, table: Column) -> Column:
        """Ids of a hexadecimal word: a token itself, or folded."""
        token = let(_lookup(table, self.ranks, word), lambda rank: F.when(rank.isNotNull(), F.array(rank)))
        return F.coalesce(token, self.fold(word, table))

    def encode_column(self, text: Column) -> Column:
        """Array of ids of a text, with higher-order functions alone."""
        # The rank map is bound once; its copies would each be parsed and shipped.
        return let(
            self.ranks.literal(), lambda table: F.flatten(F.transform(self.words(text), lambda w: self.word_ids(w, table)))
        )

    def encoder(self, spark: SparkSession, text: str):
        """Arrow batches with ``ids`` and the bytes ``decoded`` from them."""
        sent, pattern = spark.sparkContext.broadcast((self.by_bytes, self.frequent)), self.plain_pattern

        def run(batches):
            ranks, packed = sent.value
            tokens = [b""] * (max(ranks.values(), default=-1) + 1)
            for token, rank in ranks.items():
                tokens[rank] = token
            find, ids_of, bytes_of = regex.compile(pattern).findall, _Known(_unpack_words(packed), ranks).__getitem__, tokens.__getitem__
            for batch in batches:
                for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                    part = batch.slice(start, ROWS_AT_ONCE)
                    ids, sizes, decoded = [], [0], []
                    for t in part.column(text).to_pylist():
                        own = list(chain.from_iterable(map(ids_of, find(t or ""))))
                        decoded.append(b"".join(map(bytes_of, own)))
                        ids.append(np.array(own, np.int32))
                        sizes.append(sizes[-1] + len(own))
                    lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(ids)))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, lists, pa.array(decoded, pa.binary())], [*part.schema.names, "ids", "decoded"]
                    )

        return run


class _Known(dict):
    """Ids of words: the folded ones, and up to ``CACHED`` others since they were last forgotten."""

    def __init__(self, frequent: dict[str, list[int]], ranks: Mapping[bytes, int]):
        super().__init__(frequent)
        self.frequent, self.ranks = frequent, ranks

    def __missing__(self, word: str) -> list[int]:
        found = merge_word(word.encode(), self.ranks)
        if len(word) <= FOLDED_BYTES:
            if len(self) > len(self.frequent) + CACHED:
                self.clear()
                self.update(self.frequent)
            self[word] = found
        return found


def _pack_words(batches):
    """The words of a task with their ids as one compressed Arrow stream."""
    tables = [pa.table({"word": b.column("word"), "ids": b.column("ids")}) for b in batches]
    if tables:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, tables[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            for table in tables:
                out.write_table(table)
        yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["packed"])


def _unpack_words(packed: list[bytes]) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for blob in packed:
        table = pa.ipc.open_stream(blob).read_all()
        out.update(zip(table["word"].to_pylist(), table["ids"].to_pylist()))
    return out


def merge_word(word: bytes, ranks: Mapping[bytes, int]) -> list[int]:
    """Ids of one word by ranked merges, two ranks renewed with each."""
    if word in ranks:
        return [ranks[word]]
    if len(word) > FOLDED_BYTES:
        return merge_long(word, ranks)
    parts = [word[k : k + 1] for k in range(len(word))]
    beside = [ranks.get(x + y, NO_RANK) for x, y in zip(parts, parts[1:])]
    while beside and (best := min(beside)) < NO_RANK:
        k = beside.index(best)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
        del beside[k]
        if k:
            beside[k - 1] = ranks.get(parts[k - 1] + parts[k], NO_RANK)
        if k < len(beside):
            beside[k] = ranks.get(parts[k] + parts[k + 1], NO_RANK)
    return [ranks[p] for p in parts]


def merge_long(word: bytes, ranks: Mapping[bytes, int]) -> list[int]:
    """The same for a word of any length: pairs wait in a heap by rank and place, parts are a linked list.

    A waiting pair is its span; it is stale when its span no longer consists of two neighbouring parts.
    """
    n = len(word)
    end = list(range(1, n + 1))  # end of the part that starts here; 0 if none does
    before = list(range(-1, n))  # start of the part that ends where this one starts
    waiting = [(rank, k, k + 2) for k in range(n - 1) if (rank := ranks.get(word[k : k + 2])) is not None]
    heapq.heapify(waiting)
    while waiting:
        _, low, high = heapq.heappop(waiting)
        middle = end[low]
        if not middle or middle >= high or end[middle] != high:
            continue
        end[low], end[middle] = high, 0
        before[high] = low
        first = before[low]
        if first >= 0 and (rank := ranks.get(word[first:high])) is not None:
            heapq.heappush(waiting, (rank, first, high))
        if high < n and (rank := ranks.get(word[low : end[high]])) is not None:
            heapq.heappush(waiting, (rank, low, end[high]))
    out, k = [], 0
    while k < n:
        out.append(ranks[word[k : end[k]]])
        k = end[k]
    return out


def add_ids(docs: DataFrame, bpe: ByteBPE, text: str = "text") -> DataFrame:
    """Documents with ``ids`` and ``decoded`` bytes."""
    docs = docs.drop("ids", "decoded")
    added = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.BinaryType())]
    return docs.mapInArrow(bpe.encoder(docs.sparkSession, text), T.StructType(docs.schema.fields + added))
