"""Benchmark decontamination: links of two words as seeds, then Smith-Waterman alignment.

Seeds. A link is two words of a test item that stand next to each other or one word apart, found in a document
next to each other or one word apart. An alignment of M matches and E errors has M - 1 steps from match to match, of
which M - 1 - E/2 at least hold one error at most and so are links. A score of M - E/2 >= T thus needs T - 1 links that
end at different words of the item and of the document, in a stretch of 3 * size - 2 * T words. Only stretches with so many are aligned, and no passage
that leaks is without them. Word counts play no part: the same document and item give the same result in any corpus.

Alignment. Such stretches of an item in a document are gathered into passages. Each passage, with as many words
around it as an alignment can reach, is aligned locally: a match scores 1, a mismatch or gap -1/2. A passage leaks if the score reaches ``SHARE`` of the item's words, and at least
``LEAST`` words or the whole item. Copies with words changed, dropped or added keep most of the score.
Of longer items a part is enough: a passage also leaks if an alignment in which each error takes off
``STRICT`` reaches ``VERBATIM``, so that many words in a row or more with a few changed, however long the item.
Such an alignment holds ``VERBATIM`` - 1 steps without an error within ``STRETCH`` words: of M = VERBATIM + 2E matches
VERBATIM - 1 + E steps, on at most VERBATIM + 3E words.

Test items are the stated query set: they are read in blocks of bounded size, each block travels to
the tasks, and the documents never move. Words are compared in lower case without ASCII punctuation.

Defined results: null or empty texts and items without words match nothing. Rows with repeated or null
ids are searched one by one; equal items are reported each. One row per document row and item, with its
best passage (word positions, end exclusive), first of equals. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from textlens.llm.words import _BASES, flat_words, mix, steps

GAPS = (1, 2)
MATCH, MISMATCH, GAP = 1.0, -0.5, -0.5
SHARE = 0.4
LEAST = 8
VERBATIM, STRICT = 13, 2.0
# Most words on which VERBATIM - 1 of the steps without an error lie closest, over all numbers of errors.
STRETCH = max((VERBATIM + 3 * e) // (1 + e // (VERBATIM - 1)) for e in range(10 * VERBATIM))
# Words of test items held at once; more are worked off in further blocks.
BLOCK_WORDS = 200_000
# Alignment cells computed together.
CELLS = 1 << 22
TABLE_BITS = 20
# Links held at once; texts with more are worked off in halves.
LINKS = 1 << 22


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of several texts and the number of words of each."""
    _, _, counts, (h,), _ = flat_words([t.lower().encode() for t in texts], marks=True)
    return h, counts


def item_blocks(items: DataFrame, id_column: str, text: str, block_words: int) -> Iterator[list[tuple[int, np.ndarray]]]:
    """(item id, word hashes) in blocks of a bounded number of words; a longer item is a block of its own."""
    block, held = [], 0
    for key, body in items.select(id_column, text).where(F.col(text).isNotNull()).toLocalIterator():
        h, _ = _words([body])
        if block and held + len(h) > block_words:
            yield block
            block, held = [], 0
        if len(h):
            block.append((key, h))
            held += len(h)
    if block:
        yield block


def _texts(batch: pa.RecordBatch, text: str) -> list[str]:
    return [t or "" for t in batch.column(text).to_pylist()]


def _links(h: np.ndarray, gap: int) -> np.ndarray:
    """Hashes of all pairs of words ``gap`` places apart; gap 0 is the word alone."""
    return mix(h[:-gap] * _BASES[0] + h[gap:] + np.uint64(2)) if gap else mix(h + np.uint64(1))


def threshold(size: np.ndarray) -> np.ndarray:
    """Least score of a leak of items of so many words."""
    return np.maximum(SHARE * size, np.minimum(size, LEAST))


class Seeds:
    """Links of a block of items: the sorted hashes and where they lie."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        self.ids = [key for key, _ in items]
        self.items = [h for _, h in items]
        self.sizes = np.array([len(h) for h in self.items], np.int64)
        least = threshold(self.sizes)
        self.need = np.maximum(np.ceil(least - 1e-9).astype(np.int64) - 1, 1)
        self.span = np.ceil(3 * self.sizes - 2 * least).astype(np.int64)
        # Items of which a dense part can leak below the share.
        self.long = least > VERBATIM
        self.tables = {}
        pairs = [(k, gap) for k, n in enumerate(self.sizes) for gap in GAPS if n > gap]
        self._add(GAPS, pairs)
        self._add((0,), [(k, 0) for k, n in enumerate(self.sizes) if n == 1])

    def _add(self, gaps: tuple[int, ...], links: list[tuple[int, int]]) -> None:
        if not links:
            return
        found = [_links(self.items[k], gap) for k, gap in links]
        keys = np.concatenate(found)
        sizes = [len(f) for f in found]
        ends = np.concatenate([np.arange(gap, gap + n) for (_, gap), n in zip(links, sizes)])
        order = np.argsort(keys, kind="stable")
        screen = np.zeros(1 << TABLE_BITS, bool)
        screen[keys & np.uint64((1 << TABLE_BITS) - 1)] = True
        table = (keys[order], np.repeat([k for k, _ in links], sizes)[order], ends[order], np.repeat([g for _, g in links], sizes)[order], screen)
        for gap in gaps:
            self.tables[gap] = table

    def places(self, h: np.ndarray, doc: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(gap, end word, first place in the table, number of places) of the links of documents that items hold."""
        out = []
        for gap, (keys, *_, screen) in self.tables.items():
            if len(h) <= gap:
                continue
            hashes = _links(h, gap)
            at = np.flatnonzero(screen[hashes & np.uint64((1 << TABLE_BITS) - 1)])
            at = at[doc[at] == doc[at + gap]]
            left, right = np.searchsorted(keys, hashes[at], "left"), np.searchsorted(keys, hashes[at], "right")
            hit = right > left
            out.append((gap, at[hit] + gap, left[hit], (right - left)[hit]))
        return out

    def hits(self, places) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(end word in the flat array, item, end word in the item, no error between) of every link."""
        at_, item_, pos_, exact_ = ([np.zeros(0, kind)] for kind in (np.int64, np.int64, np.int64, bool))
        for gap, at, left, times in places:
            at = np.repeat(at, times)
            place = np.repeat(left, times) + np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            at_.append(at)
            item_.append(self.tables[gap][1][place])
            pos_.append(self.tables[gap][2][place])
            exact_.append(self.tables[gap][3][place] == 1 if gap == 1 else np.zeros(len(place), bool))
        return np.concatenate(at_), np.concatenate(item_), np.concatenate(pos_), np.concatenate(exact_)


def align(
    item: list[np.ndarray], passage: list[np.ndarray], mismatch: float = MISMATCH, gap: float = GAP
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best local alignment of each pair: score, first and end word in the passage.

    All pairs advance together, one item word a step; the start of the best path travels along.
    """
    rows, wide = len(item), max(len(p) for p in passage)
    tall = max(len(x) for x in item)
    a, b = np.zeros((rows, tall), np.uint64), np.zeros((rows, wide), np.uint64)
    a_in, b_in = np.zeros((rows, tall), bool), np.zeros((rows, wide), bool)
    for k, (x, p) in enumerate(zip(item, passage)):
        a[k, : len(x)], a_in[k, : len(x)] = x, True
        b[k, : len(p)], b_in[k, : len(p)] = p, True
    score, start = np.zeros((rows, wide + 1)), np.tile(np.arange(wide + 1), (rows, 1))
    column = np.arange(wide + 1)
    best, first, end = np.zeros(rows), np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    every = np.arange(rows)
    for i in range(tall):
        live = a_in[:, i : i + 1] & b_in
        step = np.where((a[:, i : i + 1] == b) & live, MATCH, mismatch)
        diagonal, up = score[:, :-1] + step, score[:, 1:] + gap
        take = diagonal >= up
        new, origin = np.zeros_like(score), np.tile(column, (rows, 1))
        new[:, 1:] = np.where(take, diagonal, up)
        origin[:, 1:] = np.where(take, start[:, :-1], start[:, 1:])
        fresh = new <= 0
        new[fresh] = 0
        origin[fresh] = np.broadcast_to(column, origin.shape)[fresh]
        # Gaps along the passage: the best cell to the left, less ``gap`` for each word between.
        level = new - gap * column
        lead = np.maximum.accumulate(level, axis=1)
        behind = lead > level
        source = np.maximum.accumulate(np.where(behind, 0, column), axis=1)
        new = np.where(behind, lead + gap * column, new)
        origin = np.take_along_axis(origin, source, axis=1)
        score = np.where(a_in[:, i : i + 1], new, score)
        start = np.where(a_in[:, i : i + 1], origin, start)
        peak = np.argmax(score, axis=1)
        high = score[every, peak]
        better = high > best
        best = np.where(better, high, best)
        first = np.where(better, start[every, peak], first)
        end = np.where(better, peak, end)
    return best, first, end


def _dense(key: np.ndarray, at: np.ndarray, need: np.ndarray, span: np.ndarray) -> np.ndarray:
    """Which of the sorted places (key, at) are among ``need`` of one key within ``span`` words."""
    n = len(key)
    first = np.arange(n)
    last = first + need - 1
    held = np.minimum(last, n - 1)
    full = (last < n) & (key[held] == key[first]) & (at[held] - at[first] <= span)
    open_ = np.zeros(n + 1, np.int64)
    np.add.at(open_, first[full], 1)
    np.add.at(open_, last[full] + 1, -1)
    return np.cumsum(open_[:-1]) > 0


def _in_dense(key: np.ndarray, at: np.ndarray, need: np.ndarray, span: np.ndarray) -> np.ndarray:
    """The same for places that may come several times and then count once."""
    other = np.ones(len(key), bool)
    other[1:] = (key[1:] != key[:-1]) | (at[1:] != at[:-1])
    return _dense(key[other], at[other], need[other], span[other])[np.cumsum(other) - 1]


def _stretches(seeds: Seeds, key, at, item, pos, need) -> Iterator[tuple[np.ndarray, ...]]:
    """(first, last, item) of neighbouring links with ends at ``need`` words of the item (the same holds for an alignment)."""
    if len(at) == 0:
        return
    new = np.ones(len(at), bool)
    new[1:] = (key[1:] != key[:-1]) | (at[1:] - at[:-1] > seeds.span[item[1:]])
    edge = np.flatnonzero(new)
    stretch = np.cumsum(new) - 1
    width = int(seeds.sizes.max())
    ends = np.bincount(np.unique(stretch * width + pos) // width, minlength=len(edge))
    kept = ends >= need[edge]
    yield at[edge][kept], at[np.append(edge[1:], len(at)) - 1][kept], item[edge][kept]


def _passages(seeds: Seeds, places, doc: np.ndarray, begins: np.ndarray, counts: np.ndarray):
    """(document, item, from, to) of the stretches of text to align."""
    at, item, pos, exact = seeds.hits(places)
    key = doc[at] * len(seeds.items) + item
    least = np.where(seeds.long, np.minimum(seeds.need, VERBATIM - 1), seeds.need)
    # Pairs that share a slot only raise each other's count.
    slot = key % LINKS
    many = np.flatnonzero(np.bincount(slot)[slot] >= least[item]) if len(key) else key
    many = many[np.lexsort((at[many], key[many]))]
    at, item, key, pos, exact = at[many], item[many], key[many], pos[many], exact[many]
    # By the share of the item, then by dense parts of long ones.
    for chosen, need, span in (
        (np.ones(len(at), bool), seeds.need[item], seeds.span[item]),
        (exact & seeds.long[item], np.full(len(at), VERBATIM - 1), np.full(len(at), STRETCH)),
    ):
        of = np.flatnonzero(chosen)
        of = of[_in_dense(key[of], at[of], need[of], span[of])]
        for first, last, k in _stretches(seeds, key[of], at[of], item[of], pos[of], need[of]):
            d, reach = doc[first], seeds.span[k]
            low = np.maximum(first - reach, begins[d])
            high = np.minimum(last + 1 + reach, begins[d] + counts[d])
            yield from zip(d.tolist(), k.tolist(), low.tolist(), high.tolist())


def _aligned(seeds: Seeds, found, h: np.ndarray, mismatch: float = MISMATCH, gap: float = GAP):
    """Score passages in groups of similar size, so that little of the padding is wasted."""
    found = sorted(found, key=lambda f: (f[3] - f[2], len(seeds.items[f[1]]), f))
    group, cells = [], 0
    for f in [*found, None]:
        size = (f[3] - f[2] + 1) * len(seeds.items[f[1]]) if f else 0
        if group and (f is None or cells + size > CELLS):
            yield from zip(group, *align([seeds.items[g[1]] for g in group], [h[g[2] : g[3]] for g in group], mismatch, gap))
            group, cells = [], 0
        if f:
            group.append(f)
            cells += size


def _best(seeds: Seeds, texts: list[str]) -> list[tuple[int, int, float, int, int]]:
    """(text, item, score, first, end) of the best leak of each item in each text."""
    h, counts = _words(texts)
    begins = np.cumsum(counts) - counts
    doc = np.repeat(np.arange(len(counts)), counts)
    places = seeds.places(h, doc)
    if len(texts) > 1 and sum(int(times.sum()) for *_, times in places) > LINKS:
        half = len(texts) // 2
        return _best(seeds, texts[:half]) + [(d + half, *hit) for d, *hit in _best(seeds, texts[half:])]
    best: dict[tuple[int, int], tuple] = {}
    found = set(_passages(seeds, places, doc, begins, counts))
    held = {}
    for passage, score, first, end in _aligned(seeds, found, h):
        d, k, low, _ = passage
        size = len(seeds.items[k])
        start = int(low - begins[d] + first)
        hit = (-score / size, start, int(low - begins[d] + end))
        if score >= threshold(size):
            best[d, k] = min(best.get((d, k), hit), hit)
        elif seeds.long[k] and score >= VERBATIM:
            held[passage] = hit
    for passage, score, *_ in _aligned(seeds, held, h, -STRICT, -STRICT):
        d, k, *_ = passage
        if score >= VERBATIM:
            best[d, k] = min(best.get((d, k), held[passage]), held[passage])
    return [(d, k, -s, a, b) for (d, k), (s, a, b) in sorted(best.items())]


def _finder(seeds: Seeds, id_column: str, text: str, schema: pa.Schema):
    def run(batches):
        for batch in batches:
            texts, ids = _texts(batch, text), batch.column(id_column).to_pylist()
            done = 0
            for part in steps([len(t) for t in texts]):
                rows = [(ids[done + d], seeds.ids[k], s, a, b) for d, k, s, a, b in _best(seeds, texts[part])]
                done += len(texts[part])
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema
                    )

    return run


def leaks(
    docs: DataFrame,
    items: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Pairs (document id, item id) with ``score`` (share of the item, 0 to 1), ``start`` and ``end``."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T.StructType([
        docs.schema[id_column], items.schema[item_id], T.StructField("score", T.DoubleType()),
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    ])
    arrow = to_arrow_schema(schema)
    slim = docs.select(id_column, text)
    found = docs.sparkSession.createDataFrame([], schema)
    for block in item_blocks(items, item_id, item_text, block_words):
        seeds = Seeds(block)
        found = found.unionByName(slim.mapInArrow(_finder(seeds, id_column, text, arrow), schema))
    return found


def _clean(seeds: Seeds, text: str):
    def run(batches):
        for batch in batches:
            texts, leaked = _texts(batch, text), np.zeros(batch.num_rows, bool)
            done = 0
            for part in steps([len(t) for t in texts]):
                leaked[[done + d for d, *_ in _best(seeds, texts[part])]] = True
                done += len(texts[part])
            yield batch.filter(pa.array(~leaked))

    return run


def without_leaks(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The rows of ``docs`` that hold no test item; one pass over the texts for each block of items."""
    kept = docs
    for block in item_blocks(items, item_id, item_text, block_words):
        kept = kept.mapInArrow(_clean(Seeds(block), text), docs.schema)
    return kept
