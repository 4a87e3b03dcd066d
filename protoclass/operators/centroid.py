"""Topic centroids (F5) and their norms (F2).

The centroid of a topic is the mean of its training documents' weight
vectors. Because ``w = tf * q(term)`` with a per-term factor ``q``, the sum
over a topic's documents is ``q(term) * sum(tf)``: term counts are summed per
``(topic, term)`` first (map-side partial sums, then one shuffle of the
small result) and weighted once per centroid entry, in the same join that
builds the scoring table, instead of weighting every training posting. Scoring uses the exact integer sums ``sw``; the mean
``w = sw / n_train`` only rescales, which cosine ignores.

For scoring, the centroids form a matrix of terms by topics, cut into blocks of
``width`` topics: topics are numbered by name, and a term has one row for each
block in which some topic holds it, with an array of that block's entries. A
posting meets a block, not a topic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .labels import clean_topics
from .lookup import DEFAULT_MAX_BROADCAST_BYTES, ROW_OVERHEAD, string_bytes
from .ordinal import with_ordinal
from .weights import sum_of_products


def topic_term_counts(train_terms: DataFrame) -> DataFrame:
    """``(topic, term, tf_sum)`` over training documents (``doc_terms`` rows
    with a ``topics`` column). Documents of equal labels are added up first, so
    a posting is a row once, not once for each of its document's topics."""
    labelled = train_terms.select(clean_topics("topics").alias("topics"), "tfs").where(F.size("topics") > 0)
    per_set = (labelled.select("topics", F.explode("tfs").alias("_t"))
               .groupBy("topics", F.col("_t.term").alias("term"))
               .agg(F.sum(F.col("_t.tf")).alias("tf_sum")))
    return (per_set.select(F.explode("topics").alias("topic"), "term", "tf_sum")
            .groupBy("topic", "term").agg(F.sum("tf_sum").alias("tf_sum")))


def centroid_sums(train_terms: DataFrame, factors: DataFrame) -> DataFrame:
    """F5 numerator: ``(topic, term, sw)`` with ``sw = q(term) * tf_sum``.

    The join on ``term`` has at most one row per topic on the centroid side
    and one row on the factor side, so no key can be hot.
    """
    counts = topic_term_counts(train_terms)
    return (counts.join(factors.select("term", "q"), on="term", how="inner")
            .select("topic", "term", (F.col("tf_sum") * F.col("q")).alias("sw")))


def small(df: DataFrame, n_bytes: int | None, max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its measured bytes are known to fit."""
    return F.broadcast(df) if n_bytes is not None and n_bytes <= max_broadcast_bytes else df


def topic_row_bytes(topic: Column) -> Column:
    """Bytes of a topic-keyed row: its name, a few numbers, and bookkeeping."""
    return string_bytes(topic) + F.lit(64 + ROW_OVERHEAD)


def centroids(sums: DataFrame, vocabulary: DataFrame, topic_bytes: int | None = None,
              max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``(topic, term, sw, n_train, w)`` with the mean weight ``w = sw / n_train``.
    The topic vocabulary is broadcast only when its measured bytes fit."""
    v = small(vocabulary.select("topic", "n_train"), topic_bytes, max_broadcast_bytes)
    return (sums.join(v, on="topic")
            .withColumn("w", F.col("sw").cast("double") / F.col("n_train").cast("double")))


def topic_norms(sums: DataFrame, exact: bool = True) -> DataFrame:
    """F2 per topic: ``(topic, n2)`` = squared norm of the centroid sums."""
    return sums.groupBy("topic").agg(sum_of_products(F.col("sw"), F.col("sw"), exact).alias("n2"))


def topic_index(tnorms: DataFrame, topic_bytes: int | None = None,
                max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``(topic, no, n2, root)`` of the topics with a non-empty centroid:
    their number by name, from 0, and the root of their squared norm. Topics
    whose measured bytes would fit a broadcast are numbered in one task."""
    defined = tnorms.where(F.col("n2") > 0)
    if topic_bytes is not None and topic_bytes <= max_broadcast_bytes:
        placed = defined.withColumn("_place", F.row_number().over(Window.orderBy("topic")).cast("bigint"))
    else:
        placed = with_ordinal(defined, ["topic"], "_place")
    return placed.select("topic", (F.col("_place") - 1).alias("no"), "n2", F.sqrt(F.col("n2").cast("double")).alias("root"))


def slots_of(width: int, n_topics: int) -> int:
    """Slots of a block: no more than there are topics."""
    return max(1, min(int(width), int(n_topics)))


def topic_blocks(index: DataFrame, width: int) -> DataFrame:
    """``(block, names, roots)``: the names and norms of each block's topics, by slot."""
    slot = F.struct(F.col("no"), F.col("topic"), F.col("root"))
    rows = index.groupBy(F.expr(f"no div {int(width)}").alias("block")).agg(F.sort_array(F.collect_list(slot)).alias("_s"))
    return rows.select("block", F.col("_s.topic").alias("names"), F.col("_s.root").alias("roots"))


def blocked_entries(sums: DataFrame, index: DataFrame, width: int, n_topics: int) -> DataFrame:
    """The centroid matrix: ``(term, block, entries, held, most)`` with the
    block's ``sw`` by slot (NULL where a topic lacks the term), how many of its
    topics hold the term, and their largest entry over the norm (an upper bound
    of what a unit of the term's weight adds to a similarity)."""
    slot = F.col("no") % width
    spread = [F.max(F.when(slot == i, F.col("sw"))).alias(f"_e{i}") for i in range(slots_of(width, n_topics))]
    rows = (sums.join(index, "topic").groupBy("term", F.expr(f"no div {int(width)}").alias("block"))
            .agg(*spread, F.count(F.lit(1)).alias("held"), F.max(F.col("sw").cast("double") / F.col("root")).alias("most")))
    return rows.select("term", "block", F.array(*[F.col(f"_e{i}") for i in range(len(spread))]).alias("entries"), "held", "most")


def score_tables(factors: DataFrame, entries: DataFrame, n_topics: int, n_blocks: int,
                 tail_share: float | None = None) -> tuple[DataFrame, DataFrame | None]:
    """``(table, tail)``: what postings are scored with.

    ``table``: ``(term, df, q, block, entries, most, own)``, at least one row for
    every indexed term, ``own`` true in exactly one of them. ``tail_share``: terms
    that more than this share of the topics hold have a single row there,
    without entries but with their bound ``most``; ``tail`` has their entries.
    """
    f = factors.select("term", "df", "q")
    none = F.lit(None).cast("double")
    if n_blocks <= 1 and tail_share is None:
        rows = f.join(entries.select("term", "entries"), "term", "left")
        return rows.select("term", "df", "q", F.lit(0).cast("bigint").alias("block"), "entries", none.alias("most"), F.lit(True).alias("own")), None
    bounds = entries.groupBy("term").agg(F.sum("held").alias("_held"), F.max("most").alias("_most"), F.min("block").alias("_first"))
    limit = float("inf") if tail_share is None else tail_share * n_topics
    known = f.join(bounds, "term", "left").withColumn("_tail", F.coalesce(F.col("_held") > F.lit(limit), F.lit(False)))
    inner = known.join(entries.select("term", "block", "entries"), "term", "left")
    first = F.coalesce("_first", F.lit(0).cast("bigint"))
    block = F.coalesce("block", first)
    table = inner.where(~F.col("_tail") | (F.col("block") == F.col("_first"))).select(
        "term", "df", "q", block.alias("block"), F.when(~F.col("_tail"), F.col("entries")).alias("entries"),
        F.when(F.col("_tail"), F.col("_most")).alias("most"), (block == first).alias("own"))
    if tail_share is None:
        return table, None
    return table, inner.where("_tail").select("term", "df", "q", "block", "entries")


def table_sizes(factors: DataFrame, sums: DataFrame, width: int, n_topics: int) -> tuple[int, int, int]:
    """``(total df, bytes of factors, bytes of the score table at most)``,
    measured in one job over the flat inputs."""
    slots = slots_of(width, n_topics)
    n_blocks = -(-n_topics // width)
    f = factors.agg(F.sum("df").alias("a"), F.sum(string_bytes(F.col("term")) + F.lit(32 + ROW_OVERHEAD)).alias("b"))
    row = string_bytes(F.col("term")) + F.lit(80 + 9 * slots + ROW_OVERHEAD)
    if n_blocks <= 1:
        t = factors.agg(F.lit(0).cast("bigint").alias("a"), F.sum(row).alias("b"))
    else:
        held = sums.groupBy("term").agg(F.least(F.count(F.lit(1)), F.lit(n_blocks)).alias("_rows"))
        t = held.agg(F.lit(0).cast("bigint").alias("a"), F.sum(F.col("_rows") * row).alias("b"))
    rows = f.select(F.lit(0).alias("k"), "*").unionByName(t.select(F.lit(1).alias("k"), "*")).collect()
    by = {r["k"]: r for r in rows}
    own = int(by[0]["b"] or 0)
    return int(by[0]["a"] or 0), own, (0 if n_blocks <= 1 else 2 * own) + int(by[1]["b"] or 0)
