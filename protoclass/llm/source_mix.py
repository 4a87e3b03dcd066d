"""Operator 3: mixing sources to target weights by a hypergeometric splitting tree.

1. Sizes: words of every text, summed by source.
2. Targets: sources by code point (null last) weigh 5, 2, 1, repeating, and
   share ``SHARE`` times all sizes; a target stops at ``MOST`` times its
   source's size, and the excess is shared again by weight until none is above.
3. Streams: each source's documents stand in a permuted order (a keyed hash),
   cut into blocks of equally many words. The mix takes whole rounds of the
   stream and then its first documents up to the target: documents are taken
   whole or not at all, the one at the cut if more than half of it is before
   it, so a source is off its target by half a document at most. Its quota in
   blocks is exact.
4. Tree: the quota vector is split recursively among the output shards. A node
   draws its left half's blocks from its vector without replacement
   (multivariate hypergeometric), seeded by the node, so reruns agree and the
   nodes of a level are independent rows.
5. Blocks: a keyed permutation numbers the blocks of every round; the numbers
   are dealt to the shards as disjoint ranges of the leaf counts. Documents of
   a block go to its shard and stand there in a hashed order.

The words before a document in its source come from a range partitioning of
(source, hash), so a hot source spreads over many tasks. One task holds the
quota vector (a number per source), never rows of a source. Sources are joined
to documents by a broadcast of measured size, or by a skew-safe join beyond.
There are as many shards as input splits (``spark.sql.files.maxPartitionBytes``)
would hold the mix, up to ``MAX_SHARDS``; beyond that the texts of a shard are
dealt to several tasks by ranges of their hashed place, so a task's texts do not
grow with the data.

Defined results: null and empty texts have size 0 and nothing taken; a source
of size 0 has target 0; a null source is one of its own; ties in the hash go by
id; repeated rows are documents of their own; an empty table gives no rows;
other columns pass through ``mixed_documents`` as they came.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from protoclass.llm.common import WORD_PATTERN, broadcast_if_fits, in_worker, packed, prefix_sums, same, shuffle_partitions, table, written
from protoclass.operators.routing import split_bytes

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2.0
#: Words in a block, as long as all quotas together stay below ``MAX_BLOCKS``.
BLOCK_WORDS = 256
MAX_BLOCKS = 1 << 29
MAX_SHARDS = 4096
#: Bytes that a word of text, with what stands beside it in its row, takes up, about.
WORD_BYTES = 8
#: Leaf ranges looked through at a time.
RANGES_AT_ONCE = 64
SEED = 20240601
#: Primes above ``MAX_BLOCKS``.
PRIMES = (1073741827, 1073741831, 1073741833, 1073741839, 1073741843, 1073741857, 1073741891, 1073741909)


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, h: the narrow table everything works on."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.regexp_count(text, F.lit(WORD_PATTERN)).cast("bigint").alias("size"),
                       F.xxhash64(F.lit(SEED), "doc_id", text).alias("h"))


def targets(sources: DataFrame) -> DataFrame:
    """source, source_size, weight, target from one row per source."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1  # a row per source, not per document
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int"))
    rows = written(sources.withColumn("weight", weight), "mix-sources")
    most = F.col("source_size") * MOST
    total = rows.agg(F.sum("source_size")).first()[0] or 0
    level, capped = None, -1
    while True:  # the level rises until no further source is above its most; each round caps one more at least
        full = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= most
        held = rows.agg(F.sum(F.when(full, most).otherwise(0.0)), F.sum(F.when(~full, F.col("weight")).otherwise(0.0)), F.count(F.when(full, 1))).first()
        if held[2] == capped or not held[1]:
            break
        level, capped = (total * SHARE - held[0]) / held[1], held[2]
    target = F.lit(0.0) if level is None else F.least(most, F.col("weight") * F.lit(float(level)))
    return rows.withColumn("target", target.cast("double"))


def _splits(left: int, quota: np.ndarray, seed: list[int]) -> np.ndarray:
    """Blocks of each source in a half of ``left`` blocks, drawn without replacement."""
    rng = np.random.default_rng(seed)
    return rng.multivariate_hypergeometric(quota, left, method="marginals") if left else np.zeros_like(quota)


def splitting_tree(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """One row per shard and source with blocks: shard, k (place of the source
    in ``quotas``), n, before (the source's blocks in earlier shards).
    ``quotas``: k, quota."""
    root = quotas.groupBy().agg(F.sort_array(F.collect_list(F.struct("k", "quota"))).alias("q")).select(
        F.lit(0).alias("low"), F.lit(shards).alias("high"), F.col("q.quota").alias("counts"), F.transform("q.quota", lambda x: F.lit(0).cast("bigint")).alias("before"))

    def grow(most: int):
        """Splits every node until it spans at most ``most`` shards."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                open_ = b.to_pylist()
                while open_:
                    row = open_.pop()
                    low, high = row["low"], row["high"]
                    if high - low <= most:
                        yield pa.RecordBatch.from_pylist([row], schema=_NODES)
                        continue
                    counts, before = np.array(row["counts"], np.int64), np.array(row["before"], np.int64)
                    mid = (low + high) // 2
                    # Shards differ by a block at most.
                    first = _splits(int(counts.sum()) * (mid - low) // (high - low), counts, [seed, low, high])
                    open_.append({"low": low, "high": mid, "counts": first, "before": before})
                    open_.append({"low": mid, "high": high, "counts": counts - first, "before": before + first})

        return in_worker("source_mix", run)

    # The upper half of the tree in one task, the subtrees below it in many.
    nodes, schema = root, "low int, high int, counts array<bigint>, before array<bigint>"
    nodes = nodes.mapInArrow(grow(max(1, round(shards**0.5))), schema)
    nodes = nodes.repartition(shuffle_partitions(quotas.sparkSession), "low").mapInArrow(grow(1), schema)
    pair = F.explode(F.arrays_zip("counts", "before", F.sequence(F.lit(0), F.size("counts") - 1).alias("k")))
    leaves = nodes.filter(F.size("counts") > 0).select(F.col("low").alias("shard"), pair.alias("e"))
    return leaves.select("shard", F.col("e.k").alias("k"), F.col("e.counts").alias("n"), F.col("e.before").alias("before")).filter("n > 0")


_NODES = pa.schema([("low", pa.int32()), ("high", pa.int32()), ("counts", pa.list_(pa.int64())), ("before", pa.list_(pa.int64()))])


def permuted(number: Column, n: Column, key: Column) -> Column:
    """``number`` under a keyed permutation of 0 to n-1: a multiplication by a
    prime above every ``n`` and a shift, modulo ``n``. The blocks it numbers
    hold hashed documents, so the order needs no more mixing."""
    prime = F.element_at(F.array(*(F.lit(p).cast("bigint") for p in PRIMES)), (F.pmod(key, F.lit(len(PRIMES))) + 1).cast("int"))
    n = F.greatest(n, F.lit(1).cast("bigint"))
    return F.pmod(F.pmod(number, n) * prime + F.pmod(F.shiftright(key, 8), n), n)


def task_words(spark: SparkSession) -> int:
    """Words of an input split's worth of text."""
    return max(1, split_bytes(spark) // WORD_BYTES)


def mix(docs: DataFrame, shards: int | None = None, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """(documents, pieces). Documents: doc_id, source, size, h, source_size,
    target, taken, one row per document. Pieces: doc_id, source, h, size, round,
    block, shard, place: one row for each time a document is taken, at most
    ``MOST`` of them; ``place`` orders a shard."""
    narrow = written(sizes(docs), "mix-sizes")
    by_source = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")))
    total = by_source.agg(F.sum("target")).first()[0] or 0.0
    block = max(BLOCK_WORDS, int(total // MAX_BLOCKS) + 1)
    shards = shards or max(1, min(MAX_SHARDS, math.ceil(total / task_words(docs.sparkSession))))
    goal = F.round("target").cast("bigint")
    rounds = F.when(F.col("source_size") > 0, F.floor(goal / F.col("source_size"))).otherwise(0).cast("bigint")
    by_source = by_source.withColumn("rounds", rounds).withColumn("rest", goal - F.col("rounds") * F.col("source_size"))
    blocks_in = lambda words: F.ceil(F.col(words) / F.lit(block)).cast("bigint")
    by_source = (by_source.withColumn("k", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
                 .withColumn("n_blocks", blocks_in("source_size")).withColumn("rest_blocks", blocks_in("rest"))
                 .withColumn("quota", F.col("rounds") * F.col("n_blocks") + F.col("rest_blocks")))
    by_source = written(by_source, "mix-targets")

    side = broadcast_if_fits(by_source.withColumnRenamed("source", "_source"))
    placed = prefix_sums(narrow, ["source"], [F.col("h"), F.col("doc_id")], "size", "at", "mix-placed")
    placed = placed.join(side, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    rest = F.when(2 * (F.col("rest") - F.col("at")) >= F.col("size"), F.col("size")).otherwise(0)
    documents = placed.withColumn("rest_taken", rest).withColumn("taken", F.col("rounds") * F.col("size") + F.col("rest_taken"))

    # Blocks of all rounds of a source have one number each: the round's blocks
    # in a permuted order behind those of the rounds before.
    number = (F.col("at") / F.lit(block)).cast("bigint")
    of_round = F.when(F.col("round") < F.col("rounds"), F.col("n_blocks")).otherwise(F.col("rest_blocks"))
    taken = (F.col("round") < F.col("rounds")) | (F.col("rest_taken") > 0)
    pieces = (documents.filter("taken > 0").withColumn("round", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("rounds"))))
              .filter(taken).withColumn("block", number).withColumn("of_round", of_round))
    pieces = pieces.withColumn("slot", F.col("round") * F.col("n_blocks") + permuted(F.col("block"), F.col("of_round"), F.xxhash64(F.lit(seed), "k", "round")))

    tree = written(splitting_tree(by_source.select("k", "quota"), shards, seed), "mix-tree")
    # All leaf ranges of a source in one array, in shard order; one of the few at a time that a slot can be in is looked through.
    ranges = tree.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("before", "shard"))).alias("ranges")).withColumnRenamed("k", "_k")
    ranges = ranges.withColumn("heads", F.transform(F.sequence(F.lit(1), F.size("ranges"), F.lit(RANGES_AT_ONCE)), lambda i: F.col("ranges")[i - 1]["before"]))
    pieces = pieces.join(broadcast_if_fits(ranges), F.col("k") == F.col("_k"))
    head = F.aggregate("heads", F.lit(0), lambda n, before: n + F.when(before <= F.col("slot"), 1).otherwise(0))
    near = F.slice("ranges", (F.greatest(head, F.lit(1)) - 1) * RANGES_AT_ONCE + 1, RANGES_AT_ONCE)
    shard = F.aggregate(near, F.lit(0), lambda best, r: F.when(r["before"] <= F.col("slot"), r["shard"]).otherwise(best))
    pieces = pieces.withColumn("shard", shard).withColumn("place", F.xxhash64(F.lit(seed), "shard", "h", "round"))
    pieces = written(pieces.select("doc_id", "source", "h", "size", "at", "round", "block", "shard", "place"), "mix-pieces")
    # What the mix takes of a row is what was drawn: the words of its pieces.
    row = ["doc_id", "source", "h", "size", "at"]
    drawn = pieces.groupBy(*row).agg(F.sum("size").alias("taken")).select(*(F.col(c).alias(f"_{c}") for c in row), "taken")
    whole = documents.select(*row, "source_size", "target").join(drawn, same([F.col(c) for c in row], [F.col(f"_{c}") for c in row]), "left")
    return whole.select("doc_id", "source", "size", "h", "source_size", "target", F.coalesce("taken", F.lit(0).cast("bigint")).alias("taken")), pieces


def mixed_documents(docs: DataFrame, shards: int | None = None, seed: int = SEED) -> DataFrame:
    """The mix as documents: a row for each time a document is taken, whole,
    with all its columns as they came. Rows of a shard stand together, in the
    shard's shuffled order."""
    _, pieces = mix(docs, shards, seed)
    spark = docs.sparkSession
    # Copies of one row stand in one stream side by side. They are told apart
    # only by counts, so a row with a million copies is still a few takes.
    row = ["doc_id", "source", "h"]
    takes = pieces.groupBy(*row, "round", "shard", "place").agg(F.count("*").alias("n"))
    takes = takes.groupBy(*(F.col(c).alias(f"_{c}") for c in row)).agg(F.collect_list(F.struct("shard", "place", "n")).alias("_takes"))
    copies = sizes(docs).groupBy(*row).agg(F.count("*").alias("_m")).filter("_m > 1").select(*(F.col(c).alias(f"_c{c}") for c in row), "_m")
    here = [F.col(f"_{c}") for c in row]
    takes = takes.join(copies, same(here, [F.col(f"_c{c}") for c in row]), "left").drop(*(f"_c{c}" for c in row))
    takes = written(takes, "mix-takes")
    size = pieces.agg(F.sum("size").alias("words"), F.max("shard").alias("shard")).first()
    n_shards = 1 + (size["shard"] or 0)
    per_shard = max(1, math.ceil((size["words"] or 0) / n_shards / task_words(spark)))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    doc_id = F.col("doc_id").cast("bigint")
    rows = packed(docs, doc_id=doc_id, source=F.col("source").cast("string"), h=F.xxhash64(F.lit(SEED), doc_id, text))
    joined = rows.join(broadcast_if_fits(takes), same([F.col(c) for c in row], here))
    once = joined.filter("_m is null").unionByName(joined.filter("_m is not null").dropDuplicates(row))
    each = once.withColumn("t", F.explode("_takes")).withColumn("i", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("t.n"))))
    # Places are hashes, evenly spread: a shard's texts are dealt to its tasks by equal ranges of them.
    part = F.floor((F.col("t.place") / F.lit(2.0**64) + 0.5) * per_shard).cast("int")
    each = each.withColumn("part", F.col("t.shard") * per_shard + F.least(part, F.lit(per_shard - 1)))
    dealt = each.repartitionById(n_shards * per_shard, F.col("part")).sortWithinPartitions(F.col("t.shard"), F.col("t.place"))
    return dealt.select("row.*")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = mix(table(spark, sf_dir, "documents"))
    return documents.select("doc_id", "size", "source_size", "target", "taken")
