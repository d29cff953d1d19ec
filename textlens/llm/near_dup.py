"""Near-duplicate groups by BagMinHash signatures of word shingles.

A text is the multiset of its five-word shingles, weight = count. For every shingle the weight axis is cut
into the intervals (0,1], (1,2], (2,4], (4,8], ...; each interval is a Poisson process in time whose rate is the
interval's width, seeded by shingle and interval, so texts that share it see the same points. A point
belongs to a text if its place on the weight axis is below the weight, and draws one of the signature's
components. The earliest point of each component is the signature: two texts agree in a component with
the probability of their weighted Jaccard similarity. Points come in order of time, so a process stops when it is
later than all components, and a text costs little more than one draw per shingle.

Signatures are cut into bands. A pair that shares a band is verified by its exact multiset overlap
``sum min / sum max``; pairs of ``SIMILAR`` or more are links, and a group is a connected component of links.
42 bands of 6 components miss a pair of similarity 0.8 with odds of 3 in a million.

Scale. Equal contents become one node before anything else. The members of a band are first compared with one
of them only, the one that shares most bands with most other texts. Members of one band that then lie in different components and
were not compared yet are compared afterwards: as pairs in small bands; members of large ones whole
group by whole group in blocks, which compares no fewer and moves a text once per block instead of once per pair. No link is lost. Components come from alternating large and small stars, of
``FEW_LINKS`` links at most from one task in one pass. Nothing is collected.

Defined results: texts with fewer than five words are one shingle of all their words; texts without words (null,
empty, blank) are copies of each other. The class of a group is its smallest non-null id, null if it has none.
Rows with repeated ids count as rows. Empty tables give empty results. Shingles are compared by 64-bit hashes (40
bits inside a verified pair) and contents by 64 bits: n different contents collide with odds of n^2 / 2^65.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from textlens.llm import batches as B
from textlens.llm.words import flat_words, mix, rolling, steps
from textlens.session import ensure_checkpoint_dir

SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 42, 6
# Members of one band that are still apart: up to LARGE they are paired, beyond that compared block by block.
LARGE, BLOCK = 64, 256
# Links of this number at most are joined by one task in one pass.
FEW_LINKS = 200_000
# The blocks of small components.
SHARED = ""
_A, _B = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)


def _salt(k: int) -> np.uint64:
    return np.uint64(k * int(_B) & 0xFFFFFFFFFFFFFFFF)


def saved(df: DataFrame) -> DataFrame:
    """Cut the lineage in the session's shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


class Bags:
    """Distinct shingles, their counts and their texts, for several texts."""

    def __init__(self, texts: list[bytes], n: int = SHINGLE):
        _, _, counts, (h,), _ = flat_words(texts)
        begins = np.cumsum(counts) - counts
        place = np.arange(len(h)) - np.repeat(begins, counts)
        size = np.repeat(counts, counts)
        doc = np.repeat(np.arange(len(counts)), counts)
        whole = (size - place >= n)[: max(0, len(h) - n + 1)]
        keys, docs = [rolling(h, n)[whole]], [doc[: len(whole)][whole]]
        for m in range(1, n):  # texts of m < n words: one shingle
            short = np.flatnonzero(counts == m)
            if len(short):
                acc = h[begins[short]]
                for k in range(1, m):
                    acc = acc * _A + h[begins[short] + k]
                keys.append(mix(acc + np.uint64(m)))
                docs.append(short)
        key, doc = np.concatenate(keys), np.concatenate(docs)
        order = np.lexsort((key, doc))
        key, doc = key[order], doc[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        edge = np.flatnonzero(new)
        self.key, self.doc = key[edge], doc[edge]
        self.count = np.diff(np.append(edge, len(key)))
        self.texts = len(texts)
        self.begins = np.searchsorted(self.doc, np.arange(len(texts) + 1))

    def nodes(self) -> np.ndarray:
        """A 64-bit name of the whole multiset; 0 without shingles."""
        each = mix(mix(self.key) + self.count.astype(np.uint64) * _B)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(each, dtype=np.uint64)))
        total = sums[self.begins[1:]] - sums[self.begins[:-1]]
        return np.where(np.diff(self.begins) > 0, mix(total), np.uint64(0)).view(np.int64)


def signatures(bags: Bags, m: int) -> np.ndarray:
    """BagMinHash signature of each text: names of the earliest points of m components."""
    streams, rates, lows, weights, docs = [bags.key], [np.ones(len(bags.key))], [np.zeros(len(bags.key))], [bags.count], [bags.doc]
    low = 1
    while (more := bags.count > low).any():
        # The interval (low, 2 * low], of rate low.
        streams.append(mix(bags.key[more] + _salt(-low)))
        rates.append(np.full(int(more.sum()), float(low)))
        lows.append(np.full(int(more.sum()), float(low)))
        weights.append(bags.count[more])
        docs.append(bags.doc[more])
        low *= 2
    stream, rate, low_, weight, doc = (np.concatenate(x) for x in (streams, rates, lows, weights, docs))
    time = np.zeros(len(stream))
    earliest = np.full(bags.texts * m, np.inf)
    names = np.zeros(bags.texts * m, np.uint64)
    drawn = 0
    while len(stream):
        drawn += 1
        wait = mix(stream + _salt(2 * drawn))
        time = time - np.log(((wait >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / rate
        draw = mix(stream + _salt(2 * drawn + 1))
        height = low_ + rate * ((draw >> np.uint64(32)).astype(np.float64) * 2.0**-32)
        inside = np.flatnonzero((height < weight) | (low_ == 0))
        at = doc[inside] * m + ((draw[inside] & np.uint64(0xFFFFFFFF)) % np.uint64(m)).astype(np.int64)
        np.minimum.at(earliest, at, time[inside])
        won = earliest[at] == time[inside]
        names[at[won]] = draw[inside][won]
        latest = earliest.reshape(bags.texts, m).max(axis=1)
        live = time < latest[doc]
        stream, rate, low_, weight, doc, time = (x[live] for x in (stream, rate, low_, weight, doc, time))
    return names.reshape(bags.texts, m)


def bands(signature: np.ndarray, count: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature."""
    parts = signature.reshape(len(signature), count, rows)
    out = np.tile(np.arange(count, dtype=np.uint64) * _A, (len(signature), 1))
    for k in range(rows):
        out = mix(out * _B + parts[:, :, k])
    return out.view(np.int64)


def _encoded(batch: pa.RecordBatch, text: str) -> list[bytes]:
    return [t.encode() if t is not None else b"" for t in batch.column(text).to_pylist()]


def _describer(text: str, count: int, rows: int):
    def run(batches):
        for batch in batches:
            texts = _encoded(batch, text)
            done = 0
            for part in steps([len(t) for t in texts]):
                bags = Bags(texts[part])
                keys = bands(signatures(bags, count * rows), count, rows)
                offsets = pa.array(np.arange(0, keys.size + 1, count, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").slice(done, bags.texts), pa.array(bags.nodes()),
                     pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))], ["id", "node", "bands"],
                )
                done += bags.texts

    return run


def _bag_blobs(text: str):
    def run(batches):
        seen: set[int] = set()  # copies in one partition are sent once
        for batch in batches:
            texts = _encoded(batch, text)
            for part in steps([len(t) for t in texts]):
                bags = Bags(texts[part])
                rows = []
                for k, node in enumerate(bags.nodes().tolist()):
                    if node not in seen:
                        seen.add(node)
                        x = slice(bags.begins[k], bags.begins[k + 1])
                        keys, inverse = np.unique(bags.key[x] >> np.uint64(24), return_inverse=True)
                        counts = np.bincount(inverse, bags.count[x], len(keys)).astype(np.int64)
                        packed = B.pack_counts(counts)
                        rows.append((node, int(counts.sum()), len(packed).to_bytes(8, "little") + packed + B.pack(keys)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], ["node", "size", "bag"])

    return run


def _opened(bag: bytes) -> tuple[np.ndarray, np.ndarray]:
    size = int.from_bytes(bag[:8], "little")
    return B.unpack(bag[8 + size :]), B.unpack_counts(bag[8 : 8 + size]).astype(np.int64)


def overlap(bag_a: bytes, bag_b: bytes) -> float:
    """Weighted Jaccard similarity of two bags."""
    (ka, ca), (kb, cb) = _opened(bag_a), _opened(bag_b)
    if len(ka) == 0 or len(kb) == 0:
        return float(len(ka) == len(kb))
    at = np.minimum(np.searchsorted(kb, ka), len(kb) - 1)
    shared = int(np.minimum(ca, cb[at])[kb[at] == ka].sum())
    return shared / (int(ca.sum()) + int(cb.sum()) - shared)


def _verifier(similar: float):
    def run(batches):
        for batch in batches:
            pairs = zip(batch.column("bag_a").to_pylist(), batch.column("bag_b").to_pylist())
            linked = pa.array([overlap(a, b) >= similar for a, b in pairs], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), linked], ["a", "b", "linked"])

    return run


def verify(pairs: DataFrame, bags: DataFrame, similar: float) -> DataFrame:
    """(a, b, linked) of pairs of nodes, by their exact overlap. Sizes too far apart are not compared."""
    side = lambda x: bags.select(F.col("node").alias(x), F.col("size").alias("size_" + x), F.col("bag").alias("bag_" + x))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    ratio = F.least("size_a", "size_b") >= F.greatest("size_a", "size_b") * F.lit(similar)
    return both.where(ratio).select("a", "b", "bag_a", "bag_b").mapInArrow(_verifier(similar), "a long, b long, linked boolean")


def _block_links(similar: float):
    """Links between the members of two blocks (or within one), thinned to a forest: enough to join them."""

    def run(table: pa.Table) -> pa.Table:
        nodes, lo, hi = np.asarray(table["node"]), table["lo"][0].as_py(), table["hi"][0].as_py()
        block = np.asarray(table["block"])
        units, of = [], []
        for k, bag in enumerate(table["bag"].to_pylist()):
            keys, counts = _opened(bag)
            # A shingle that occurs c times is c units, so shared units add up to sum min.
            turn = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
            units.append(mix(np.repeat(keys, counts) + turn.astype(np.uint64) * _A))
            of.append(np.full(len(turn), k, np.int32))
        size = np.array([len(u) for u in units], np.float64)
        _, unit, times = np.unique(np.concatenate(units), return_inverse=True, return_counts=True)
        of = np.concatenate(of)
        column = np.cumsum(times > 1) - 1
        inside = (times > 1)[unit]
        column, of = column[unit[inside]], of[inside]
        order = np.argsort(column, kind="stable")
        column, of = column[order], of[order]
        shared = np.zeros((len(nodes), len(nodes)), np.float32)
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            x, y = np.searchsorted(column, [start, start + 4096])
            incidence = np.zeros((len(nodes), 4096), np.float32)
            incidence[of[x:y], column[x:y] - start] = 1
            shared += incidence @ incidence.T
        whole = size[:, None] + size[None, :] - shared
        link = np.triu(shared >= similar * whole, 1) & (whole > 0)
        if lo != hi:
            link &= block[:, None] != block[None, :]
        label, kept = np.arange(len(nodes)), []
        for i, j in zip(*np.nonzero(link)):
            if label[i] != label[j]:
                label[label == label[j]] = label[i]
                kept.append((int(nodes[i]), int(nodes[j])))
        a, b = zip(*kept) if kept else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def compare_blocks(tied: DataFrame, labels: DataFrame, bags: DataFrame, similar: float) -> DataFrame:
    """Links between members of each large group that lie in different components, block by block.

    ``tied`` has (node, group), ``labels`` (node, label) the components so far. A component of more than ``BLOCK`` members of a group
    has blocks of its own, which don't meet each other; the members of smaller ones share blocks. A member travels once for
    each block it meets, not once for each partner, and no task holds more than two blocks.
    """
    placed = tied.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    own = placed.groupBy("group", "label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > BLOCK)
    own = own.select("group", "label", F.col("label").cast("string").alias("part"))
    placed = placed.join(own, ["group", "label"], "left").withColumn("part", F.coalesce("part", F.lit(SHARED)))
    parts = placed.groupBy("group", "part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    number = F.xxhash64("part", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    members = placed.join(parts, ["group", "part"]).select("group", "node", "part", number.alias("block"))
    every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.xxhash64("part", k.cast("int")))
    faced = parts.select("group", F.col("part").alias("other"), F.explode(every).alias("facing"))
    meets = (F.col("part") == SHARED) | (F.col("part") != F.col("other"))
    dealt = members.join(bags, "node").join(faced, "group").where(meets)
    dealt = dealt.select("group", "node", "bag", "block", F.least("block", "facing").alias("lo"), F.greatest("block", "facing").alias("hi"))
    return dealt.groupBy("group", "lo", "hi").applyInArrow(_block_links(similar), "a long, b long")


def forest(stars: DataFrame) -> DataFrame:
    """Fewer links (a, b) with the components of the links (node, head): a node keeps one head, its heads are tied to each other."""
    by = stars.groupBy("node").agg(F.sort_array(F.collect_set("head")).alias("heads"))
    first = by.select(F.col("node").alias("a"), F.get("heads", F.lit(0)).alias("b"))
    rest = F.explode(F.slice("heads", 2, F.greatest(F.size("heads") - 1, F.lit(0))))
    return first.unionByName(by.select(rest.alias("a"), F.get("heads", F.lit(0)).alias("b")).distinct())


def components(links: DataFrame) -> DataFrame:
    """(node, label) of all nodes of the links (a, b), the label being the smallest node of the component."""
    edges = saved(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    if edges.count() <= FEW_LINKS:  # rounds of shuffles are more work than the links, for the driver too
        return saved(edges.coalesce(1).mapInArrow(_joined, "node long, label long"))
    state = None
    while True:
        # Large star: every larger neighbour is tied to the smallest one (or the node itself).
        both = _either(edges, ("u", "v"), ("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _either(both.join(low, "u").where("v > u"), ("v", "m")).distinct()
        # Small star: a node and its smaller neighbours are tied to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = _either(large.join(low, "u"), ("v", "m"), ("u", "m")).where("u <> v")
        edges = saved(small.distinct())
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    ends = _either(edges, ("u", "v"), ("v", "v")).distinct()
    return ends.select(F.col("u").alias("node"), F.col("v").alias("label"))


def _joined(batches):
    """The components of all links (u, v) of a task, ``FEW_LINKS`` at most."""
    ends = [(np.asarray(b.column("u")), np.asarray(b.column("v"))) for b in batches]
    if not ends:
        return
    u, v = (np.concatenate(side) for side in zip(*ends))
    nodes, places = np.unique(np.concatenate((u, v)), return_inverse=True)
    a, b = places[: len(u)], places[len(u) :]
    root = np.arange(len(nodes))
    while (apart := root[a] != root[b]).any():
        # Of two roots with a link the larger goes below the smaller; half of those that are left, at least, go each time.
        x, y = root[a[apart]], root[b[apart]]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], ["node", "label"])


def _either(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """(u, v) rows for each of the column pairs of every row."""
    made = [F.struct(F.col(x).alias("u"), F.col(y).alias("v")) for x, y in pairs]
    return df.select(F.explode(F.array(*made)).alias("e")).select("e.u", "e.v")


def _ordered_pair(x: Column, y: Column) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


class Groups:
    """Near-duplicate groups of a table: ``rows`` (id, node, label)."""

    def __init__(
        self, docs: DataFrame, id_column: str = "doc_id", text: str = "text",
        similar: float = SIMILAR, count: int = BANDS, rows: int = ROWS,
    ):
        slim = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
        kind = slim.schema["id"].dataType.simpleString()
        described = saved(slim.mapInArrow(_describer("text", count, rows), f"id {kind}, node long, bands array<long>"))
        nodes = described.groupBy("node").agg(F.first("bands").alias("bands"))
        members = nodes.select("node", F.explode("bands").alias("band"))
        sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        shared = saved(members.join(sizes, "band"))
        # The member that shares most bands with most others is nearest to the middle of its group.
        rank = shared.groupBy("node").agg(F.sum("size").alias("rank"))
        ranked = shared.select("node", "band").join(rank, "node")
        heads = ranked.groupBy("band").agg(F.max_by("node", F.struct("rank", "node")).alias("head"))
        stars = shared.select("node", "band").join(heads, "band").where("node <> head")
        stars = saved(stars.select("node", "head").distinct())
        involved = shared.select("node").distinct()
        bags = slim.select("text").mapInArrow(_bag_blobs("text"), "node long, size long, bag binary")
        self.bags = saved(bags.join(involved, "node", "left_semi").dropDuplicates(["node"]))
        checked = verify(stars.select(F.col("node").alias("a"), F.col("head").alias("b")), self.bags, similar)
        links = saved(checked.where("linked").select("a", "b"))
        labels = components(forest(links.select(F.col("a").alias("node"), F.col("b").alias("head"))))
        # Members of one band in different components that were not compared yet.
        placed = shared.select("node", "band").join(labels, "node", "left")
        placed = placed.withColumn("label", F.coalesce("label", "node"))
        mixed = placed.groupBy("band").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x < y")
        open_ = saved(placed.join(mixed.select("band"), "band"))
        size = open_.groupBy("band").agg(F.count(F.lit(1)).alias("size"), F.min("node").alias("head"))
        small = open_.join(size.where(F.col("size") <= LARGE).select("band"), "band")
        other = small.select(F.col("node").alias("node2"), F.col("label").alias("label2"), "band")
        pairs = small.join(other, "band").where("label < label2")
        pairs = pairs.select(*_ordered_pair(F.col("node"), F.col("node2"))).distinct()
        compared = stars.select(*_ordered_pair(F.col("node"), F.col("head")))
        rest = verify(pairs.join(compared, ["a", "b"], "left_anti"), self.bags, similar)
        large = open_.join(size.where(F.col("size") > LARGE).select("band", "head"), "band")
        tied = components(forest(large.select("node", "head"))).withColumnRenamed("label", "group")
        # Each half is written down by a plan of its own: the driver holds and plans anew what is in one plan.
        blocked = saved(compare_blocks(tied, labels, self.bags, similar))
        found = saved(rest.where("linked").select("a", "b")).unionByName(blocked)
        # What was found ties components, not nodes: few links, whatever the size of the groups.
        at = lambda x: labels.select(F.col("node").alias(x), F.col("label").alias("label_" + x))
        between = found.join(at("a"), "a", "left").join(at("b"), "b", "left")
        between = between.select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
        between = saved(between.where("a <> b").distinct())
        if between.head(1):
            joined = components(between)
            whole = labels.join(joined.select(F.col("node").alias("label"), F.col("label").alias("root")), "label", "left")
            alone = joined.join(labels, "node", "left_anti")  # nodes that had no link before
            labels = whole.select("node", F.coalesce("root", "label").alias("label")).unionByName(alone)
        named = described.select("id", "node").join(labels, "node", "left")
        self.rows = named.select("id", "node", F.coalesce("label", "node").alias("label"))

    def classes(self) -> DataFrame:
        """One row per input row: id, class (smallest id of the group) and number of rows in the group."""
        by = self.rows.groupBy("label").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("group_size"))
        return self.rows.join(by, "label").select("id", "class_id", "group_size")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each group: the one with the smallest id (nulls last, then by content)."""
    groups = Groups(docs, id_column, text, **options)
    best = F.struct(F.col("id").isNull().alias("no_id"), "id", "node")
    keepers = groups.rows.groupBy("label").agg(F.min(best).alias("k")).select("k.id", "k.node")
    schema = docs.schema
    tagged = _with_node(docs, text)
    kept = tagged.join(
        keepers.select(F.col("id").alias("__id"), F.col("node").alias("__node_kept")),
        tagged["__node"].eqNullSafe(F.col("__node_kept")) & tagged[id_column].eqNullSafe(F.col("__id")),
        "left_semi",
    )
    # Rows equal in id and content are one document.
    return kept.dropDuplicates(["__node", id_column]).select(*schema.fieldNames())


def _with_node(docs: DataFrame, text: str) -> DataFrame:
    from pyspark.sql import types as T

    schema = T.StructType(docs.schema.fields + [T.StructField("__node", T.LongType())])

    def run(batches):
        for batch in batches:
            texts, nodes = _encoded(batch, text), [np.zeros(0, np.int64)]
            for part in steps([len(t) for t in texts]):
                nodes.append(Bags(texts[part]).nodes())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(nodes))], [*batch.schema.names, "__node"])

    return docs.mapInArrow(run, schema)


def oracle_sql(documents: str = "documents", similar: float = SIMILAR) -> str:
    """DuckDB SQL of ``classes``: all pairs that share a shingle, then reachability."""
    shingle = " || ' ' || ".join(f"w[i + {k}]" for k in range(SHINGLE))
    return rf"""
    WITH RECURSIVE s AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM {documents}),
    g AS (SELECT doc_id, CASE WHEN len(w) < {SHINGLE} THEN array_to_string(w, ' ') ELSE {shingle} END AS g
        FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {SHINGLE - 2}, 2))) AS i FROM s)),
    b AS (SELECT doc_id, g, count(*) AS n FROM g GROUP BY ALL),
    t AS (SELECT doc_id, sum(n) AS n FROM b GROUP BY doc_id),
    o AS (SELECT x.doc_id AS a, y.doc_id AS b, sum(least(x.n, y.n)) AS o FROM b x JOIN b y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM o JOIN t p ON p.doc_id = a JOIN t q ON q.doc_id = b WHERE o / (p.n + q.n - o) >= {similar}),
    r AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
    c AS (SELECT a AS doc_id, min(b) AS class_id FROM r GROUP BY a)
    SELECT doc_id, class_id, doc_id = class_id AS kept, (count(*) OVER (PARTITION BY class_id))::BIGINT AS group_size FROM c"""
