"""Operator 9: n-gram Jaccard join by chosen paths.

A text's set holds the hashes of its windows of five words (lower-cased; the
whole text if it has fewer). Texts with the same set form one record. In each
run a record follows sampled tokens: a token of its set is chosen at a node if
a hash of node and token falls below 1 / (similarity x set size), so two sets
that share most tokens tend to choose the same ones, and every chosen token is
a path. Records on one path form a bucket. A bucket above ``SPLIT_ABOVE``
records is split by the tokens chosen next; the buckets left are compared by
brute force, and runs repeat until the wanted recall (``runs_for``).

Comparing: a pair is looked at only in the first of its common buckets, if
sizes and 64-bin sketches allow the similarity. Records with such a pair get
their texts, and the exact Jaccard similarity of the whole sets decides. Tasks
return per record its number of links and its place in a spanning forest, never
pairs, so a group of thousands of near copies yields thousands of rows, not
millions. A bucket beyond ``BLOCK_RECORDS`` records or ``BLOCK_TOKENS`` tokens is
cut into blocks by a hash of the record, and the blocks meet two by two (a
tile) in different tasks: what a task holds at once is two blocks' sets, a
count for each pair of their records, and ``STRIP`` rows of anything wider.
Components of the forests are the classes.

Result: one row per document with class_id (the least id of its class) and
n_links (other documents at least as similar as the threshold).

Defined results: null and empty texts have no set, are classes of their own and
link to nothing; documents of one text link to each other; repeated rows are
documents; a class of null ids alone has a null class_id; an empty table gives
no rows; other columns are not read, and pass through ``one_of_each`` as they came.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from protoclass.llm.common import CACHES, WORDS, broadcast_if_small, in_worker, packed, same, table, written

WIDTH = 5
SIMILARITY = 0.8
RECALL = 0.9999
DEPTH = 2
SPLIT_ABOVE = 256
BLOCK_RECORDS = 1024
BLOCK_TOKENS = 1_000_000
BINS = 64
#: Sketches decide only for larger sets; smaller ones are compared at once.
SKETCHED_FROM = 65
#: Share of equal bins below which two sketches rule the similarity out: about
#: six standard deviations below it.
SKETCH_SHARE = 0.5
#: Columns of the matrices that count common tokens, and their rows looked at, at a time.
CHUNK = 2048
STRIP = 128
#: Edges that one file of a table of stars holds.
EDGES_A_FILE = 250_000
#: Texts taken out of an Arrow batch, and rows given back in one, at a time.
ROWS_AT_ONCE = 256
_COLUMNS_AT_ONCE = 1 << 16
#: Rough seconds: of a pair looked up, of each of its tokens, of a token put
#: into a matrix, and of a product of two matrix entries. They choose between
#: two ways of counting the same.
_PER_PAIR, _PER_LOOKUP, _PER_ENTRY, _PER_PRODUCT = 1.2e-5, 5e-8, 4e-7, 5e-11

_C1, _C2, _C3 = (np.uint64(c) for c in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53, 0x9E3779B97F4A7C15))
_FACTORS = [np.uint64(c) for c in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _C1
    x = (x ^ (x >> np.uint64(29))) * _C2
    return x ^ (x >> np.uint64(32))


class _Hashes(dict):
    """Word to 64-bit hash; bounded."""

    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        self[word] = h
        return h


_HASHES = _Hashes()
CACHES["chosen_path"] = _HASHES.clear


def token_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the windows of ``width`` words."""
    words = WORDS.findall((text or "").lower())
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(width, len(h))
    n = len(h) - width + 1
    total = np.full(n, width, np.uint64)
    for k in range(width):
        total += h[k : n + k] * _FACTORS[k % len(_FACTORS)]
    return np.unique(_mixed(total))


def runs_for(recall: float, similarity: float, depth: int) -> int:
    """Runs after which a pair of that similarity has met with that chance: it
    shares 2s/(1+s) of two equal sets, and a path goes on with the chance that
    one of the shared tokens is chosen and goes on."""
    shared = 2 * similarity / (1 + similarity)
    p = 1.0
    for _ in range(depth):
        p = 1 - math.exp(-shared / similarity * p)
    return math.ceil(math.log(1 - recall) / math.log(1 - p))


def _chosen(nodes: np.ndarray, x: np.ndarray, limit: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """(index of the node, path behind it) for every token chosen at a node."""
    at, paths = [], []
    for a in range(0, len(x), _COLUMNS_AT_ONCE):
        part = x[a : a + _COLUMNS_AT_ONCE]
        i, j = np.nonzero(_mixed(nodes[:, None] ^ part[None, :]) <= limit)
        at.append(i)
        paths.append(_mixed(nodes[i] + part[j] * _C3))
    return np.concatenate(at), np.concatenate(paths)


def paths(x: np.ndarray, runs: int, similarity: float, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every depth (index of the parent path, path) of a set's tree."""
    limit = np.uint64(min(2**64 - 1, int(2**64 / (similarity * len(x)))))
    nodes = _mixed(np.arange(1, runs + 1, dtype=np.uint64) * _C3)
    out = []
    for _ in range(depth):
        parent, nodes = _chosen(nodes, x, limit)
        out.append((parent, nodes))
        if not len(nodes):
            out += [(np.zeros(0, np.int64), nodes)] * (depth - len(out))
            break
    return out


def sketch(x: np.ndarray) -> np.ndarray:
    """One byte for each of 64 bins of the hash space: of the least token in it; 0 if none."""
    edges = np.arange(BINS, dtype=np.uint64) << np.uint64(58)
    at = np.searchsorted(x, edges)
    has = at < np.append(at[1:], len(x))
    out = np.zeros(BINS, np.uint8)
    out[has] = (x[at[has]] & np.uint64(0xFFFF)) % np.uint64(255) + np.uint64(1)
    return out


# --- candidate pairs of a bucket ------------------------------------------

class Bucket:
    """The records of one tile of a bucket: of one block (``left`` and ``right``
    are all of them), or of two, whose records are compared across."""

    def __init__(self, rows: pa.Table, similarity: float):
        self.rows, self.similarity = rows, similarity
        self.key, tile = rows.column("key")[0].as_py(), rows.column("tile")[0].as_py()
        self.n = rows.column("n").to_numpy()
        self.sketches = np.frombuffer(b"".join(rows.column("sketch").to_pylist()), np.uint8).reshape(-1, BINS)
        block = rows.column("block").to_numpy()
        self.across = tile >> _TILE_BITS != tile & ((1 << _TILE_BITS) - 1)
        self.left = np.flatnonzero(block == tile >> _TILE_BITS)
        self.right = np.flatnonzero(block == tile & ((1 << _TILE_BITS) - 1)) if self.across else self.left

    def _met(self) -> np.ndarray | None:
        """Which pairs have met in an earlier bucket, by place in left and right; None if all have."""
        g = len(self.n)
        place = np.empty((2, g), np.int64)
        place[0, self.left], place[1, self.right] = np.arange(len(self.left)), np.arange(len(self.right))
        in_left, in_right = np.zeros(g, bool), np.zeros(g, bool)
        in_left[self.left], in_right[self.right] = True, True
        earlier = defaultdict(list)
        for i, keys in enumerate(self.rows.column("keys").to_pylist()):
            for k in keys:
                if k < self.key:
                    earlier[k].append(i)
        met = np.zeros((len(self.left), len(self.right)), bool)
        for members in earlier.values():
            if len(members) == g:
                return None
            if len(members) > 1:
                m = np.array(members)
                met[np.ix_(place[0, m[in_left[m]]], place[1, m[in_right[m]]])] = True
        return met

    def _alike(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs' sketches allow the similarity."""
        out = np.zeros(len(i), bool)
        for a in range(0, len(i), 1 << 16):
            p, q = i[a : a + (1 << 16)], j[a : a + (1 << 16)]
            s, t = self.sketches[p], self.sketches[q]
            equal = ((s == t) & (s > 0)).sum(axis=1)
            either = BINS - ((s == 0) & (t == 0)).sum(axis=1)
            out[a : a + (1 << 16)] = (equal >= SKETCH_SHARE * either) | (np.minimum(self.n[p], self.n[q]) < SKETCHED_FROM)
        return out

    def pairs(self) -> np.ndarray | None:
        """The pairs to compare here, by place in left and right: not met in an
        earlier bucket, and not ruled out by sizes or sketches; None if there are none."""
        met = self._met()
        if met is None:
            return None
        wanted = ~met
        n = self.n.astype(np.float64)
        right = n[self.right]
        for a in range(0, len(self.left), STRIP):
            left = n[self.left[a : a + STRIP], None]
            open_ = wanted[a : a + STRIP]
            open_ &= np.minimum(left, right) >= self.similarity * np.maximum(left, right)
            if not self.across:
                open_ &= np.arange(len(right)) > np.arange(a, a + len(left))[:, None]
            i, j = np.nonzero(open_)
            if len(i):
                open_[i, j] = self._alike(self.left[a + i], self.right[j])
        return wanted if wanted.any() else None

    def used(self, wanted: np.ndarray) -> np.ndarray:
        """The records that some wanted pair holds."""
        return np.union1d(self.left[wanted.any(axis=1)], self.right[wanted.any(axis=0)])


def _buckets(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[Bucket]:
    """The tiles of sorted batches, one after another; only one is held, and
    batches are taken in small pieces, so that a long tile copies little."""
    held: list[pa.RecordBatch] = []
    at: tuple | None = None
    for b in (b.slice(a, ROWS_AT_ONCE) for b in batches for a in range(0, b.num_rows, ROWS_AT_ONCE)):
        keys, tiles = b.column("key").to_numpy(), b.column("tile").to_numpy()
        starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]) | (tiles[1:] != tiles[:-1])) + 1), b.num_rows]
        for a, z in zip(starts, starts[1:]):
            if (keys[a], tiles[a]) != at:
                if sum(x.num_rows for x in held) > 1:
                    yield Bucket(pa.Table.from_batches(held).combine_chunks(), similarity)
                held, at = [], (keys[a], tiles[a])
            held.append(b.slice(a, z - a))
    if sum(x.num_rows for x in held) > 1:
        yield Bucket(pa.Table.from_batches(held).combine_chunks(), similarity)


def _incidence(sets: list[np.ndarray], tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(set, place in ``tokens``) of all tokens of the sets that are among ``tokens``, by place."""
    rows, columns = [], []
    for k, x in enumerate(sets):
        at = np.searchsorted(tokens, x)
        at[at == len(tokens)] = 0
        at = at[tokens[at] == x].astype(np.int32)
        columns.append(at)
        rows.append(np.full(len(at), k, np.int32))
    row, column = np.concatenate(rows), np.concatenate(columns)
    order = np.argsort(column, kind="stable")
    return row[order], column[order]


def _repeated(sets: list[np.ndarray]) -> np.ndarray:
    """The tokens that stand in two of the sets."""
    every = np.concatenate(sets)
    every.sort()
    again = every[1:][every[1:] == every[:-1]]
    return again[np.concatenate(([True], again[1:] != again[:-1]))] if len(again) else again


def common_counts(left: list[np.ndarray], right: list[np.ndarray], wanted: np.ndarray, across: bool = True) -> np.ndarray:
    """Common tokens of the ``wanted`` pairs of the sets ``left`` and ``right``
    (the same ones unless ``across``); what it says of other pairs means nothing."""
    sizes = sum(map(len, left)), sum(map(len, right)) if across else 0
    mean = sum(sizes) / (len(left) + (len(right) if across else 0))
    one_by_one = wanted.sum() * (_PER_PAIR + mean * _PER_LOOKUP)
    tokens = None
    if one_by_one > sum(sizes) * _PER_ENTRY:
        tokens = _repeated(left + right if across else left)
        if one_by_one < sum(sizes) * _PER_ENTRY + len(tokens) * len(left) * len(right) * _PER_PRODUCT:
            tokens = None
    total = np.zeros((len(left), len(right)), np.float32)  # counts up to 2^24 are exact
    if tokens is None:
        for a, b in zip(*np.nonzero(wanted), strict=True):
            x, y = (left[a], right[b]) if len(left[a]) <= len(right[b]) else (right[b], left[a])
            at = np.searchsorted(y, x)
            at[at == len(y)] = 0
            total[a, b] = (y[at] == x).sum()
        return total
    # Most pairs are wanted: product of the two set-by-token matrices, some tokens at a time.
    sides = [_incidence(left, tokens), _incidence(right, tokens) if across else None]
    for a in range(0, len(tokens), CHUNK):
        parts = []
        for (row, column), of in zip(filter(None, sides), (left, right)):
            s, e = np.searchsorted(column, (a, a + CHUNK))
            m = np.zeros((len(of), CHUNK), np.float32)
            m[row[s:e], column[s:e] - a] = 1
            parts.append(m)
        total += parts[0] @ parts[-1].T
    return total


def _least(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``label``, each record's least linked one so far, after the links (i, j) too."""
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        for side in (i, j):
            np.minimum.at(new, side, low)
            np.minimum.at(new, label[side], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compare(bucket: Bucket, set_of: Callable[[int], np.ndarray]) -> tuple[np.ndarray, np.ndarray] | None:
    """(links of every record, the least record of its component) over the pairs
    of a tile; None without a pair to compare. ``set_of`` gives a record's set."""
    wanted = bucket.pairs()
    if wanted is None:
        return None
    none = np.zeros(0, np.uint64)
    sets = [none] * len(bucket.n)
    for k in bucket.used(wanted):
        sets[k] = set_of(int(k))
    rows, columns = wanted.any(axis=1), wanted.any(axis=0)
    if not bucket.across:
        rows = columns = rows | columns
    left, right = bucket.left[rows], bucket.right[columns]
    wanted = wanted[np.ix_(rows, columns)]
    common = common_counts([sets[k] for k in left], [sets[k] for k in right], wanted, bucket.across)
    m = bucket.rows.column("m").to_numpy()
    count, label = np.zeros(len(bucket.n), np.int64), np.arange(len(bucket.n))
    for a in range(0, len(left), STRIP):
        i, j = np.nonzero(wanted[a : a + STRIP])
        c = common[a + i, j].astype(np.int64)
        i, j = left[a + i], right[j]
        near = c >= bucket.similarity * (bucket.n[i] + bucket.n[j] - c) - 1e-9
        i, j = i[near], j[near]
        np.add.at(count, i, m[j])
        np.add.at(count, j, m[i])
        label = _least(label, i, j)
    return count, label


# --- the join --------------------------------------------------------------

_TILE_BITS = 31
_ROWS = "key bigint, tile bigint, block bigint, rec binary, n bigint, m bigint, sketch binary, keys array<bigint>"


def signatures(docs: DataFrame, runs: int, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, text_hash, rec (digest of the set; null without words), n, sketch, tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree_type = pa.list_(pa.struct([("k", pa.int64()), ("kids", pa.list_(pa.int64()))]))
        for b in (b.slice(a, ROWS_AT_ONCE) for b in batches for a in range(0, b.num_rows, ROWS_AT_ONCE)):
            recs, sizes, sketches, trees = [], [], [], []
            for t in b.column("text").to_pylist():
                x = token_set(t)
                sizes.append(len(x))
                if not len(x):
                    recs.append(None)
                    sketches.append(None)
                    trees.append(None)
                    continue
                recs.append(xxhash.xxh3_128_digest(x.tobytes()))
                sketches.append(sketch(x).tobytes())
                (_, first), (parent, kids) = paths(x, runs, similarity, DEPTH)
                cuts = np.searchsorted(parent, np.arange(1, len(first))) if len(first) else []
                trees.append([{"k": k, "kids": c} for k, c in zip(first.view(np.int64), np.split(kids.view(np.int64), cuts), strict=True)] if len(first) else [])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_hash"), pa.array(recs, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sketches, pa.binary()),
                 pa.array(trees, tree_type)], names=["doc_id", "text_hash", "rec", "n", "sketch", "tree"])

    text = F.col("text").cast("string")
    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), text.alias("text"))
    return narrow.mapInArrow(in_worker("chosen_path", run), "doc_id bigint, text_hash bigint, rec binary, n bigint, sketch binary, tree array<struct<k: bigint, kids: array<bigint>>>")


def _leaves(records: DataFrame) -> DataFrame:
    """rec, key, blocks: the buckets of at least two records that a record is in, and into how many blocks each is cut."""
    first = records.select("rec", "n", F.explode("tree").alias("e")).select("rec", "n", F.col("e.k").alias("key"), F.col("e.kids").alias("kids"))

    def sized(rows: DataFrame) -> DataFrame:
        sizes = rows.groupBy("key").agg(F.count("*").alias("c"), F.sum("n").alias("tokens")).filter("c > 1").withColumnRenamed("key", "_key")
        return rows.join(sizes, F.col("key") == F.col("_key")).drop("_key")

    first = written(sized(first), "paths-first")
    small = first.filter(F.col("c") <= SPLIT_ABOVE).select("rec", "key", "c", "tokens")
    # A record goes on along every token it chooses next; what is still large at the last depth is cut into blocks.
    large = first.filter(F.col("c") > SPLIT_ABOVE).select("rec", "n", F.explode("kids").alias("key")).distinct()
    blocks = F.greatest(F.lit(1), F.ceil(F.col("c") / BLOCK_RECORDS), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("bigint")
    return small.unionByName(sized(large).select("rec", "key", "c", "tokens")).select("rec", "key", blocks.alias("blocks"))


def _bucket_rows(members: DataFrame) -> DataFrame:
    """A row for each record, bucket and tile it is in."""
    block = F.pmod(F.xxhash64("rec", F.lit(3)), F.col("e.blocks"))
    low, high = F.least(F.col("block"), F.col("other")), F.greatest(F.col("block"), F.col("other"))
    rows = (members.withColumn("e", F.explode("leaves")).withColumn("block", block)
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("e.blocks") - 1))))
    return rows.select(F.col("e.key").alias("key"), (F.shiftleft(low, _TILE_BITS) + high).alias("tile"), "block", "rec", "n", "m", "sketch",
                       F.transform("leaves", lambda x: x["key"]).alias("keys"))


def _sorted_buckets(rows: DataFrame, run: Callable, schema: str) -> DataFrame:
    return rows.repartition("key", "tile").sortWithinPartitions("key", "tile", "rec").mapInArrow(in_worker("chosen_path", run), schema)


def links(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signatures, records, found). Records: rec, m (documents), id (the least,
    null if all are), least (the first document: doc_id, text_hash). Found: rec, root, links, from every
    bucket where the record has a link; the roots span the classes."""
    sigs = written(signatures(docs, runs_for(recall, similarity, DEPTH), similarity), "paths-signatures", texts=True)
    records = sigs.filter("rec is not null").groupBy("rec").agg(
        F.count("*").alias("m"), F.min("doc_id").alias("id"), F.min(F.struct("doc_id", "text_hash")).alias("least"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("tree").alias("tree"))
    records = written(records, "paths-records")
    of_record = _leaves(records.select("rec", "n", "tree")).groupBy("rec").agg(F.sort_array(F.collect_list(F.struct("key", "blocks"))).alias("leaves")).withColumnRenamed("rec", "_rec")
    members = records.select("rec", "n", "m", "sketch").join(of_record, F.col("rec") == F.col("_rec")).drop("_rec")

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in _buckets(batches, similarity):
            wanted = bucket.pairs()
            if wanted is not None:
                yield from bucket.rows.take(bucket.used(wanted)).combine_chunks().to_batches()

    candidates = written(_sorted_buckets(_bucket_rows(members), needed, _ROWS), "paths-candidates")
    n_candidates = candidates.count()

    wanted = candidates.select("rec").distinct().withColumnRenamed("rec", "_rec").join(records.select("rec", "least"), F.col("rec") == F.col("_rec"))
    wanted = wanted.select("rec", F.col("least.doc_id").alias("_doc"), F.col("least.text_hash").alias("_hash"))
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("text_hash"), text.alias("text"))
    texts = texts.join(broadcast_if_small(wanted, n_candidates, 64), same([F.col("doc_id"), F.col("text_hash")], [F.col("_doc"), F.col("_hash")]))
    # A row that is repeated comes more than once; one text of each record then meets its buckets by the same key.
    texts = texts.select(F.col("rec").alias("_rec"), "text").dropDuplicates(["_rec"])
    rows = candidates.join(texts, F.col("rec") == F.col("_rec")).drop("_rec")

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket in _buckets(batches, similarity):
            text = bucket.rows.column("text")
            told = compare(bucket, lambda k: token_set(text[k].as_py()))
            if told is None:
                continue
            count, label = told
            linked = np.flatnonzero(count)
            rec = bucket.rows.column("rec").combine_chunks()
            yield pa.RecordBatch.from_arrays([rec.take(pa.array(linked)), rec.take(pa.array(label[linked])), pa.array(count[linked])], names=["rec", "root", "links"])

    found = _sorted_buckets(rows, compared, "rec binary, root binary, links bigint")
    return sigs, records, written(found, "paths-found", texts=True)


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """rec, root: the least member of the component of every node of ``edges``
    (u, v), by large and small stars in turn until nothing changes. Tables of
    few edges are written in few files."""
    edges = written(edges.filter("u <> v").distinct(), "stars")
    state = [F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))]
    before = edges.agg(*state).first()
    files = 1 + before[0] // EDGES_A_FILE  # stars never add edges
    for _ in range(most_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("low")).withColumnRenamed("u", "_u")
        large = both.join(least, F.col("u") == F.col("_u")).filter("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = written(large.filter("u <> v").distinct().coalesce(files), "stars")
        # Small star: here every edge already points from the larger to the smaller node.
        least = large.groupBy("u").agg(F.min("v").alias("low")).withColumnRenamed("u", "_u")
        joined = large.join(least, F.col("u") == F.col("_u"))
        small = joined.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(joined.select("u", F.col("low").alias("v")))
        edges = written(small.filter("u <> v").distinct().coalesce(files), "stars")
        now = edges.agg(*state).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    stars = edges.select(F.col("u").alias("rec"), F.col("v").alias("root"))
    return stars.unionByName(stars.select("root").distinct().select(F.col("root").alias("rec"), "root"))


def classes(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """doc_id, text_hash, class_id, n_links, and class (a key of the class that
    is never null) for every document."""
    sigs, records, found = links(docs, similarity, recall)
    counts = found.groupBy("rec").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("rec").alias("u"), F.col("root").alias("v")))
    linked = counts.join(roots.withColumnRenamed("rec", "_rec"), F.col("rec") == F.col("_rec")).select(F.col("rec").alias("_rec"), "links", "root")
    whole = records.select("rec", "m", "id").join(linked, F.col("rec") == F.col("_rec"), "left").select(
        "rec", "id", F.coalesce("root", "rec").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"))
    whole = written(whole, "paths-classes")
    least = whole.groupBy("root").agg(F.min("id").alias("class_id")).withColumnRenamed("root", "_root")
    of_record = whole.join(least, F.col("root") == F.col("_root")).select(F.col("rec").alias("_rec"), "class_id", "n_links", "root")
    out = sigs.select("doc_id", "text_hash", "rec").join(of_record, F.col("rec") == F.col("_rec"), "left")
    return out.select("doc_id", "text_hash", F.when(F.col("rec").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"), F.col("root").alias("class"))


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One document of each class, the one of the least id (then of the least
    hash of its text), with all its columns; texts without words all stay."""
    told = written(classes(docs, similarity, recall), "paths-told")
    first = told.filter("class is not null").groupBy("class").agg(F.min(F.struct("doc_id", "text_hash")).alias("f"))
    same_row = told.groupBy("doc_id", "text_hash").agg(F.count("*").alias("_n")).filter("_n > 1").select(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_h"), "_n")
    stay = first.select(F.col("f.doc_id").alias("_doc"), F.col("f.text_hash").alias("_hash"))
    stay = stay.join(same_row, same([F.col("_doc"), F.col("_hash")], [F.col("_d"), F.col("_h")]), "left").select("_doc", "_hash", F.coalesce("_n", F.lit(1)).alias("_n"))
    blank = told.filter("class is null").select(F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), F.lit(1).cast("bigint").alias("_n")).distinct()
    stay = written(stay.withColumn("_n", F.col("_n").cast("bigint")).unionByName(blank), "paths-stay")
    rows = packed(docs, doc_id=F.col("doc_id").cast("bigint"), text_hash=F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))))
    kept = rows.join(broadcast_if_small(stay, stay.count(), 32), same([F.col("doc_id"), F.col("text_hash")], [F.col("_doc"), F.col("_hash")]))
    once = kept.filter("_n = 1").unionByName(kept.filter("_n > 1").dropDuplicates(["_doc", "_hash"]))
    return once.select("row.*")


def op9_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links")
