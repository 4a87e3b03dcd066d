"""Operator 6: benchmark decontamination by spaced-seed hashing.

Words are lower-cased runs of letters and digits. Each mask says which words of
a window count; the others are ignored, so a substituted word there does not
hide a copy. Hashes of the masked windows of all documents are joined with
those of the benchmark; a hit fixes a document, an item and a diagonal (the
shift between them). Along each diagonal the words are compared once: the score
of the best stretch is its equal words less ``PENALTY`` for each substituted
one, and a score of ``MIN_SCORE`` (all words, for items shorter than that) is
an overlap. The four masks lose none: whatever the places of the substituted
words, a stretch that scores ``MIN_SCORE`` has a window that one of them fits
(the tests walk all patterns; another set of masks must be checked alike).

Everything is DataFrame expressions. Documents are read twice: for the hashes,
and those with hits for the comparison; texts are not shuffled while the hits
are within the broadcast bound, and go through a shuffle join beyond.

Defined results: texts and items that are null, empty or shorter than
``MIN_WORDS`` words overlap nothing; items shorter than a mask are searched by
all their words; a null id is an id of its own; repeated rows and items give
one row per pair of ids, with the best score; empty tables give no rows; other
columns are not read, and pass through ``decontaminated`` as they came.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from protoclass.llm.common import broadcast_if_fits, packed, same, table, written

TOKEN_PATTERN = r"[\p{L}\p{N}]+"
#: 1: the word counts, 0: it is ignored.
MASKS = ("11011011", "1101010011", "11001100011", "11010010101")
PENALTY = 2
MIN_SCORE = 12
MIN_WORDS = 5


def tokens(text: Column) -> Column:
    """Hashes of a text's words."""
    words = F.regexp_extract_all(F.lower(F.coalesce(text.cast("string"), F.lit(""))), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.transform(words, lambda w: F.xxhash64(w))


def let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once for a row wherever the
    body uses it, also within its own lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _windows(t: Column, seed: int, places: list[int], span: int) -> Column:
    """Hashes of the masked window at every place of the words ``t``."""
    at = F.sequence(F.lit(1), F.size(t) - span + 1)
    hashed = F.transform(at, lambda i: F.xxhash64(F.lit(seed), *(F.get(t, i + (p - 1)) for p in places)))
    return F.when(F.size(t) >= span, hashed).otherwise(F.array().cast("array<bigint>"))


def _masks(masks: tuple[str, ...], short: list[int]) -> list[tuple[int, list[int], int]]:
    """(seed, counting places, span) of each mask, and of each short length."""
    out = [(k, [i for i, c in enumerate(m) if c == "1"], len(m)) for k, m in enumerate(masks)]
    return out + [(1000 + n, list(range(n)), n) for n in short]


def seeds(rows: DataFrame, keys: list[str], masks: list[tuple[int, list[int], int]]) -> DataFrame:
    """keys, n (words), at (place of the window), h; for every mask and window.
    ``rows`` has the keys and ``t``, the words' hashes, as an expression of its own."""
    def listed(t: Column) -> Column:
        # One array per row; a window's place is its index less the windows of the masks before it.
        return F.struct(F.size(t).alias("n"), reduce(lambda a, b: F.concat(a, b), (_windows(t, *m) for m in masks)).alias("hashes"))

    made = rows.withColumn("s", let(F.col("t"), listed)).select(*keys, F.col("s.n").alias("n"), F.posexplode("s.hashes").alias("i", "h"))
    before, at = F.lit(0), F.lit(None).cast("int")
    for _, _, span in masks:
        count = F.greatest(F.lit(0), F.col("n") - (span - 1))
        at = F.coalesce(at, F.when(F.col("i") < before + count, F.col("i") - before))
        before = before + count
    return made.withColumn("at", at)


def best_score(a: Column, b: Column) -> Column:
    """The best score of a stretch of two equally long word lists."""
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("best"))

    def step(s: Column, equal: Column) -> Column:
        now = F.greatest(F.lit(0), s["now"] + F.when(equal, 1).otherwise(-PENALTY))
        return F.struct(now.alias("now"), F.greatest(s["best"], now).alias("best"))

    return F.aggregate(F.zip_with(a, b, lambda x, y: x == y), zero, step, lambda s: s["best"])


def overlaps(docs: DataFrame, benchmark: DataFrame, masks: tuple[str, ...] = MASKS, min_score: int = MIN_SCORE) -> DataFrame:
    """doc_id, text_hash, item_id, score for every overlapping pair."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), tokens(F.col("text")).alias("t")).distinct()
    items = written(items.withColumn("length", F.size("t")).filter(F.col("length") >= MIN_WORDS), "seed-items")
    longest = max(map(len, masks))
    short = sorted(r[0] for r in items.filter(F.col("length") < longest).select("length").distinct().collect())  # below ``longest``
    plans = _masks(masks, short)
    item_seeds = written(seeds(items.withColumn("key", F.xxhash64("item_id", "t")), ["item_id", "key", "length"], plans)
                         .filter((F.col("h").isNotNull())).select("h", "item_id", "key", F.col("at").alias("item_at")).distinct(), "seed-hashes")

    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    keyed = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_hash.alias("text_hash"), F.col("text").cast("string").alias("text"))
    doc_seeds = seeds(keyed.select("doc_id", "text_hash", tokens(F.col("text")).alias("t")), ["doc_id", "text_hash"], plans)
    side = broadcast_if_fits(item_seeds.withColumnRenamed("h", "_h"))
    hits = doc_seeds.join(side, F.col("h") == F.col("_h"))
    diagonal = (F.col("at") - F.col("item_at")).alias("diagonal")
    hits = written(hits.select("doc_id", "text_hash", "item_id", "key", diagonal).distinct(), "seed-hits")

    mine, theirs = [F.col("doc_id"), F.col("text_hash")], [F.col("_doc"), F.col("_hash")]
    with_hits = hits.select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).distinct()
    texts = keyed.join(broadcast_if_fits(with_hits), same(mine, theirs), "left_semi").select("doc_id", "text_hash", tokens(F.col("text")).alias("d"))
    found = hits.withColumnsRenamed({"doc_id": "_doc", "text_hash": "_hash"})
    item_side = items.select(F.xxhash64("item_id", "t").alias("_key"), F.col("t").alias("q"))
    found = found.join(broadcast_if_fits(item_side), F.col("key") == F.col("_key"))
    pairs = texts.join(broadcast_if_fits(found), same(mine, theirs))
    from_doc, from_item = F.greatest(F.col("diagonal"), F.lit(0)), F.greatest(-F.col("diagonal"), F.lit(0))
    length = F.least(F.size("d") - from_doc, F.size("q") - from_item)
    scored = pairs.select("doc_id", "text_hash", "item_id", F.size("q").alias("length"),
                          best_score(F.slice("d", from_doc + 1, length), F.slice("q", from_item + 1, length)).alias("score"))
    return (scored.filter(F.col("score") >= F.least(F.lit(min_score), F.col("length")))
            .groupBy("doc_id", "text_hash", "item_id").agg(F.max("score").alias("score")))


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without an overlap, with all their columns."""
    found = written(overlaps(docs, benchmark).select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash")).distinct(), "seed-leaks")
    rows = packed(docs, doc_id=F.col("doc_id").cast("bigint"), text_hash=F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    on = same([F.col("doc_id"), F.col("text_hash")], [F.col("_doc"), F.col("_hash")])
    return rows.join(broadcast_if_fits(found), on, "left_anti").select("row.*")


def op6_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per contaminated document and benchmark item."""
    found = overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(F.max("score").cast("bigint").alias("score"))


#: The same without masks: every diagonal with three equal words in a row is
#: scored. No overlap is without: if no run of equal words is longer than two,
#: s substituted words part at most 2 * (s + 1) equal ones, a score of 2.
OP6_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS t FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS t FROM benchmark),
items AS (SELECT row_number() OVER () AS key, item_id, t FROM (SELECT DISTINCT item_id, t FROM b) WHERE len(t) >= 5),
docs AS (SELECT row_number() OVER () AS row, doc_id, t FROM d WHERE len(t) >= 5),
item_places AS (SELECT key, t, unnest(range(1, len(t) - 1)) AS i FROM items),
doc_places AS (SELECT row, t, unnest(range(1, len(t) - 1)) AS i FROM docs),
item_runs AS (SELECT key, i, t[i] AS w1, t[i + 1] AS w2, t[i + 2] AS w3 FROM item_places),
doc_runs AS (SELECT row, i, t[i] AS w1, t[i + 1] AS w2, t[i + 2] AS w3 FROM doc_places),
hits AS (
  SELECT DISTINCT x.row, q.key, x.i - q.i AS diagonal
  FROM doc_runs x JOIN item_runs q ON x.w1 = q.w1 AND x.w2 = q.w2 AND x.w3 = q.w3),
cells AS (
  SELECT h.row, h.key, h.diagonal, x.j, CASE WHEN docs.t[x.j + h.diagonal] = items.t[x.j] THEN 1 ELSE -2 END AS s
  FROM hits h JOIN docs USING (row) JOIN items USING (key), LATERAL (SELECT unnest(range(1, len(items.t) + 1)) AS j) x
  WHERE x.j + h.diagonal BETWEEN 1 AND len(docs.t)),
sums AS (SELECT row, key, diagonal, j, sum(s) OVER (PARTITION BY row, key, diagonal ORDER BY j) AS p, s FROM cells),
stretches AS (SELECT row, key, p - min(p - s) OVER (PARTITION BY row, key, diagonal ORDER BY j) AS score FROM sums),
best AS (SELECT row, key, max(score) AS score FROM stretches GROUP BY row, key)
SELECT docs.doc_id, items.item_id, CAST(max(score) AS BIGINT) AS score
FROM best JOIN docs USING (row) JOIN items USING (key)
WHERE score >= least(12, len(items.t)) GROUP BY docs.doc_id, items.item_id
"""
