"""Spelling variants: words one edit apart, found by asymmetric q-chunks, and the forms they belong to.

A word is cut into two disjoint chunks, its halves. One inserted, deleted or replaced code point lies in one of
them, so the other half stands in the edited word unchanged, at its old place or shifted by one. The shorter word of a pair
(or either, at equal length) contributes its chunks; the longer one all grams that such a chunk could be: of its own length's
cut at the same place, of the next shorter length's cut at the same place or one to the right. Chunk and gram meet in
a join on length, place and content, which is the join within shift one without the rows that can't meet; candidates are then
verified by their exact edit distance.

Half a word is a frequent thing (``then...``), and all words that share one would meet. A chunk's group is therefore split by
the same rule once more: the half that holds the edit has two halves of its own, one of which is preserved too. So a key is
a preserved half and the preserved quarter of the other one, three quarters of the word: four keys for a word's chunks, eight
for its grams. Nothing is capped and no pair is lost; groups are words that differ in one quarter only.

Words are counted before anything is joined (combined before the shuffle), so a frequent word is one row. Keys are 64-bit
hashes of length, place and content; a collision costs a verification and changes nothing. Forms have at least twice
the count of their words, so chains end after ``log2`` of the largest count; roots are found by pointer doubling.

Defined results: null and empty texts have no words; a null id counts as the empty text. Repeated rows count as rows. A word of
any length is a word; ties in count go to the smaller word in code-point order. An empty table gives an empty result. Only id and
text are read.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, functions as F

from textlens.llm.near_dup import saved

# Letters of a run, and what is deleted from one in how many of them.
RUN = "[a-zÀ-ÿ]+"
ONE_IN = 97
LEAST_LENGTH, LEAST_COUNT, TIMES = 5, 3, 2
PARTS = 4


def runs(docs: DataFrame, id_column: str = "doc_id", text: str = "text", least: int = LEAST_LENGTH) -> DataFrame:
    """(word): every run of letters as it counts, one code point deleted where its hash says so."""
    low = F.translate(F.coalesce(F.col(text), F.lit("")), ascii_uppercase, ascii_lowercase)
    found = F.filter(F.regexp_extract_all(low, F.lit(RUN), F.lit(0)), lambda w: F.length(w) >= least)
    id_ = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    rows = docs.select(id_.alias("id"), F.explode(found).alias("run"))
    rows = rows.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = F.pmod(F.col("h"), F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    return rows.select(F.when(F.col("h") % ONE_IN == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(words: DataFrame, least: int = LEAST_LENGTH, count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of words long and frequent enough."""
    counts = words.where(F.length("word") >= least).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.where(F.col("n") >= count)


def _cuts(length: Column) -> list[Column]:
    """Where the halves of a word of this length, and the halves of those, begin and end."""
    half = F.floor(length / 2).cast("int")
    return [F.lit(0), F.floor(half / 2).cast("int"), half, half + F.floor((length - half) / 2).cast("int"), length]


def _keys(word: Column, length: Column, shift: int) -> Column:
    """Keys of a word as a chunk owner of ``length`` would name them: the text before and after each quarter.

    What follows the quarter stands ``shift`` further right in the word than in the chunk's owner.
    """
    cut = _cuts(length)
    return F.array(*[
        F.xxhash64(length, F.lit(k), F.substr(word, F.lit(1), cut[k]), F.lit("\n"), F.substr(word, cut[k + 1] + 1 + shift))
        for k in range(PARTS)
    ])


def chunks(words: DataFrame) -> DataFrame:
    """(key, word, n) of the chunks that a word contributes as the shorter one of a pair."""
    return words.select(F.explode(_keys(F.col("word"), F.length("word"), 0)).alias("key"), "word", "n")


def grams(words: DataFrame) -> DataFrame:
    """(key, long_word, long_n) of the grams that may be a chunk of a word as long or one shorter."""
    word, length = F.col("word"), F.length("word")
    both = F.concat(_keys(word, length, 0), _keys(word, length - 1, 1))
    return words.select(F.explode(both).alias("key"), word.alias("long_word"), F.col("n").alias("long_n"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, n, long_word, long_n): pairs of words that are one edit apart, each once."""
    met = chunks(words).join(grams(words), "key")
    gap = F.length("long_word") - F.length("word")
    once = (gap == 1) | ((gap == 0) & (F.col("word") < F.col("long_word")))
    near = met.where(once & (F.levenshtein("word", "long_word", 1) == 1))
    return near.select("word", "n", "long_word", "long_n").dropDuplicates(["word", "long_word"])


def forms(words: DataFrame, times: int = TIMES) -> DataFrame:
    """(word, n, n_near, form, form_n) of all words."""
    pairs = near_pairs(words)
    side = lambda a, b, n: F.struct(F.col(a).alias("word"), F.struct((-F.col(n)).alias("less"), F.col(b).alias("form")).alias("best"))
    both = pairs.select(F.explode(F.array(side("word", "long_word", "long_n"), side("long_word", "word", "n"))).alias("e")).select("e.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min("best").alias("best"))
    joined = words.join(best, "word", "left")
    fits = -F.col("best.less") >= F.col("n") * times
    return joined.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"),
    )


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: where following the forms ends, by pointer doubling."""
    now = saved(links.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        stepped = saved(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        now = stepped.select("word", "root")
        if not stepped.where("moved").head(1):
            return now


def group_variants(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = saved(vocabulary(runs(docs, id_column, text)))
    named = saved(forms(words))
    done = named.join(roots(named), "word", "left")
    return done.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def oracle_sql(documents: str = "documents") -> str:
    """DuckDB SQL of the query: neighbours by the words that remain when one code point is deleted from each."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = (byte >> 1) ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    crc = (
        "xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all("
        "hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..'), lambda h: ('0x' || h)::BIGINT)), "
        "lambda c, v: xor(c >> 8, tbl[1 + (xor(c, v) & 255)])))"
    )
    return rf"""
    WITH RECURSIVE t AS (SELECT {table}::BIGINT[] AS tbl),
    r AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM {documents})
        WHERE length(run) >= {LEAST_LENGTH} GROUP BY ALL),
    h AS (SELECT run, n, {crc} AS h FROM r, t),
    w AS (SELECT CASE WHEN h % {ONE_IN} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
    v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
    d AS MATERIALIZED (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS rest
        FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM v)),
    p AS (SELECT x.word AS a, y.word AS b FROM d x JOIN d y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
        UNION SELECT v.word, d.word FROM v JOIN d ON d.rest = v.word
        UNION SELECT d.word, v.word FROM v JOIN d ON d.rest = v.word),
    b AS (SELECT a, count(*) AS n_near, min(struct_pack(less := -n, form := b)) AS best FROM p JOIN v ON v.word = b GROUP BY a),
    f AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near,
        CASE WHEN -best.less >= {TIMES} * n THEN best.form END AS form, CASE WHEN -best.less >= {TIMES} * n THEN -best.less END AS form_n
        FROM v LEFT JOIN b ON a = word),
    c AS (SELECT word, word AS root, 0 AS k FROM f UNION ALL SELECT c.word, f.form, k + 1 FROM c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL)
    SELECT word, form, root, n, n_near, form_n::BIGINT AS form_n FROM f JOIN (SELECT word, max_by(root, k) AS root FROM c GROUP BY word) USING (word)"""
