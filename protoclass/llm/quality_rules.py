"""Operator 2: quality rules by robust multivariate outliers.

Every text gives counts (exact, whole text) and a vector of transformed
statistics. For each language and source a minimum-covariance-determinant
(MCD) estimate of location and scatter is fitted to all its vectors by
concentration steps, and texts whose Mahalanobis distance from their group's
estimate is beyond a far chi-square quantile are rejected, as are texts that
fail the fixed base rules.

The fit never gathers a group. Vectors are written once as a narrow table. Each
concentration step is two aggregations over it: a histogram of distances per
group and start, whose cumulated counts give the radius that holds the share
``SUPPORT`` of the group, and the moments of the rows within that radius.
Starts are the whole group and ``RANDOM_STARTS`` elementary subsets (the rows
of smallest hash); after two steps each group goes on with the start of least
determinant. Estimates are one row per group, broadcast while their counted
size allows and joined with adaptive skew handling beyond.

Defined results: null lang or source are groups of their own; a group of fewer
than ``MIN_GROUP`` rows is fitted together with the other small groups of its
language, and small languages together; a pool that stays smaller than
``MIN_GROUP`` rejects nothing beyond the base rules; null and empty texts have
zero counts and fail the base rules; repeated rows count as often as they
occur; an empty table gives no rows; other columns, whatever their names, are
not read and pass through ``quality_rules`` untouched.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from protoclass.llm.common import WORDS, broadcast_if_small, in_worker, packed, same, table, written

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5

#: Share of a group whose scatter has the least determinant.
SUPPORT = 0.75
RANDOM_STARTS = 2
FIRST_STEPS = 2
LAST_STEPS = 4
MIN_GROUP = 60
#: Standard deviations added to every statistic, in its own unit: the
#: resolution below which differences mean nothing. It keeps scatters regular
#: where most of a group shares one value.
RESOLUTION = (0.05, 0.045, 0.05, 0.13, 0.13, 0.25)
#: A clean text lies beyond the cut with this probability, if normal.
TAIL = 1e-4
#: Histogram bins per doubling of the squared distance.
BINS = 64

P = len(RESOLUTION)
PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words: list[str]) -> int:
    """Words inside a window of five words that occurs at least twice."""
    n = len(words)
    if n <= WINDOW:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    base = len(number)
    if base == n:
        return 0
    if base**WINDOW < 2**63:
        key = np.zeros(n - WINDOW + 1, np.int64)
        for k in range(WINDOW):
            key = key * base + ids[k : n - WINDOW + 1 + k]
    else:  # number the windows of two, three, four, five words one after another
        key = ids
        for k in range(1, WINDOW):
            key = np.unique(key[: n - k] * base + ids[k:], return_inverse=True)[1]
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    equal = ranked[1:] == ranked[:-1]
    twice = np.zeros(len(key) + 1, bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge[:n]) > 0).sum())


def text_counts(text: str) -> tuple[list[int], list[float]]:
    """(the five counts, the transformed statistics) of a text."""
    words = WORDS.findall(text)
    n = len(words)
    chars = sum(map(len, words))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    dup = len(lines) - len(set(lines))
    repeat = repeat_words(words)
    upper = sum(map(str.isupper, words))
    digits = sum(1 for w in words if w[0].isdigit())
    vector = [
        math.log((chars + 50) / (n + 10)),
        math.sqrt(symbols / (chars + 50)),
        math.sqrt(upper / (n + 20)),
        math.sqrt(dup / (len(lines) + 2)),
        math.sqrt(repeat / (n + 20)),
        math.log((n + 20) / (len(lines) + 2)) / 4 + math.sqrt(digits / (n + 20)),
    ]
    return [n, chars, symbols, dup, repeat], vector


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, row_hash, the counts, and v0 to v5."""
    names = ["doc_id", "lang", "source", "row_hash", *COUNTS, *(f"v{i}" for i in range(P))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, vectors = [], []
            for t in b.column("text").to_pylist():
                c, v = text_counts(t or "")
                counts.append(c)
                vectors.append(v)
            c = np.array(counts, np.int64).reshape(-1, len(COUNTS))
            v = np.array(vectors, np.float64).reshape(-1, P)
            yield pa.RecordBatch.from_arrays(
                [b.column(x) for x in names[:4]] + [pa.array(c[:, i]) for i in range(len(COUNTS))] + [pa.array(v[:, i]) for i in range(P)], names=names)

    narrow = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                         F.col("source").cast("string").alias("source"), F.col("text").cast("string").alias("text"))
    narrow = narrow.withColumn("row_hash", F.xxhash64("doc_id", "text", "lang", "source"))
    schema = ("doc_id bigint, lang string, source string, row_hash bigint, " + ", ".join(f"{c} bigint" for c in COUNTS)
              + ", " + ", ".join(f"v{i} double" for i in range(P)))
    return narrow.mapInArrow(in_worker("quality_rules", run), schema)


# --- chi-square in closed form (even degrees of freedom) -------------------

def _chi2_cdf(x: float, df: int) -> float:
    term = total = 1.0
    for k in range(1, df // 2):
        term *= x / 2 / k
        total += term
    return 1 - math.exp(-x / 2) * total


def _chi2_quantile(p_above: float, df: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        term = total = 1.0
        for k in range(1, df // 2):
            term *= mid / 2 / k
            total += term
        above = math.exp(-mid / 2) * total
        low, high = (mid, high) if above > p_above else (low, mid)
    return (low + high) / 2


# --- the fit ---------------------------------------------------------------

def grouped(stats: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """Adds ``grp``: the struct (level, lang, source) whose estimate a row uses."""
    sizes = stats.groupBy("lang", "source").agg(F.count("*").alias("n"))
    per_lang = sizes.filter(F.col("n") < min_group).groupBy("lang").agg(F.sum("n").alias("n_lang"))
    sizes, per_lang = written(sizes, "quality-sizes"), written(per_lang, "quality-langs")
    n_groups, n_langs = sizes.count(), per_lang.count()
    none = F.lit(None).cast("string")
    per_lang = broadcast_if_small(per_lang.select(F.col("lang").alias("l"), "n_lang"), n_langs, 64)
    level = F.when(F.col("n") >= min_group, 0).when(F.col("n_lang") >= min_group, 1).otherwise(2)
    keys = (sizes.join(per_lang, F.col("lang").eqNullSafe(F.col("l")), "left")
            .select(F.col("lang").alias("l"), F.col("source").alias("s"),
                    F.struct(level.alias("level"), F.when(level < 2, F.col("lang")).otherwise(none).alias("lang"),
                             F.when(level < 1, F.col("source")).otherwise(none).alias("source")).alias("grp")))
    keys = written(keys, "quality-groups")
    return (stats.join(broadcast_if_small(keys, n_groups, 128), same([F.col("lang"), F.col("source")], [F.col("l"), F.col("s")]))
            .drop("l", "s"))


def _moments() -> list[Column]:
    v = [F.col(f"v{i}") for i in range(P)]
    return [F.count("*").alias("n"), *(F.sum(v[i]).alias(f"s{i}") for i in range(P)),
            *(F.sum(v[i] * v[j]).alias(f"s{i}_{j}") for i, j in PAIRS)]


def _solve(moments: DataFrame, keep_best: bool = False) -> DataFrame:
    """Location, inverse scatter and log determinant of each row's moments;
    one small task per partition of groups."""
    columns = ["n", *(f"s{i}" for i in range(P)), *(f"s{i}_{j}" for i, j in PAIRS)]
    out = [*(f"m{i}" for i in range(P)), *(f"p{i}_{j}" for i, j in PAIRS)]
    ridge = np.diag(np.square(RESOLUTION))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b.column(c).to_numpy(zero_copy_only=False).astype(float) for c in columns])
            n = np.maximum(x[:, :1], 1)
            mean = x[:, 1 : 1 + P] / n
            cov = np.zeros((len(x), P, P))
            for k, (i, j) in enumerate(PAIRS):
                cov[:, i, j] = cov[:, j, i] = x[:, 1 + P + k] / n[:, 0] - mean[:, i] * mean[:, j]
            values, vectors = np.linalg.eigh(cov)
            cov = np.einsum("nij,nj,nkj->nik", vectors, np.maximum(values, 0), vectors) + ridge
            inverse, logdet = np.linalg.inv(cov), np.linalg.slogdet(cov)[1]
            made = [mean[:, i] for i in range(P)] + [inverse[:, i, j] for i, j in PAIRS]
            yield pa.RecordBatch.from_arrays([b.column("grp"), b.column("start"), b.column("n"), *map(pa.array, made), pa.array(logdet)],
                                             names=["grp", "start", "n", *out, "logdet"])

    group = moments.schema["grp"].dataType.simpleString()
    solved = moments.mapInArrow(run, f"grp {group}, start int, n bigint, " + ", ".join(f"{c} double" for c in out) + ", logdet double")
    if keep_best:
        best = F.min_by(F.struct("n", *out, "logdet"), F.struct("logdet", "start")).alias("best")
        solved = solved.groupBy("grp").agg(best).select("grp", F.lit(0).alias("start"), "best.*")
    return written(solved, "quality-estimates")


def _distance() -> Column:
    d = [F.col(f"v{i}") - F.col(f"m{i}") for i in range(P)]
    terms = [F.col(f"p{i}_{j}") * d[i] * d[j] * F.lit(1.0 if i == j else 2.0) for i, j in PAIRS]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.greatest(total, F.lit(0.0))


def _with_estimate(rows: DataFrame, estimates: DataFrame, n_rows: int) -> DataFrame:
    side = broadcast_if_small(estimates.withColumnRenamed("grp", "_grp").drop("n", "logdet"), n_rows, 320)
    return rows.join(side, F.col("grp").eqNullSafe(F.col("_grp"))).drop("_grp").withColumn("d2", _distance())


def _concentrate(rows: DataFrame, estimates: DataFrame, n_rows: int, keep_best: bool) -> DataFrame:
    """One C-step: the moments of the rows nearest to each estimate. The radius
    is the histogram bin at which ``SUPPORT`` of the group is reached, so ties
    and the rest of the bin are in. ``keep_best``: of a group's starts, the one
    of least determinant goes on."""
    far = _with_estimate(rows, estimates, n_rows).withColumn("bin", F.floor(F.log2(F.col("d2") + F.lit(1e-6)) * BINS).cast("int"))
    histogram = far.groupBy("grp", "start", "bin").agg(F.count("*").alias("c"))
    # Bins per group and start are bounded: BINS for each doubling of a double.
    w = Window.partitionBy("grp", "start")
    reached = (histogram.withColumn("upto", F.sum("c").over(w.orderBy("bin"))).withColumn("all", F.sum("c").over(w))
               .filter(F.col("upto") >= F.col("all") * SUPPORT).groupBy("grp", "start").agg(F.min("bin").alias("radius")))
    radii = written(reached.select(F.col("grp").alias("_g"), F.col("start").alias("_s"), "radius"), "quality-radii")
    near = far.join(broadcast_if_small(radii, n_rows, 80), F.col("grp").eqNullSafe(F.col("_g")) & (F.col("start") == F.col("_s")))
    moments = near.filter(F.col("bin") <= F.col("radius")).groupBy("grp", "start").agg(*_moments())
    return _solve(moments, keep_best)


def fit(rows: DataFrame) -> tuple[DataFrame, int]:
    """The MCD estimate of every group of ``rows`` (columns grp, row_hash, v0..),
    and a bound on the number of its rows."""
    whole = rows.groupBy("grp").agg(*_moments()).withColumn("start", F.lit(0))
    v = F.struct(*(F.col(f"v{i}") for i in range(P)))
    picks = [F.min_by(v, F.struct(F.xxhash64(F.lit(s * 100 + k), "row_hash"), v)).alias(f"x{s}_{k}")
             for s in range(RANDOM_STARTS) for k in range(P + 2)]
    chosen = rows.groupBy("grp").agg(*picks)
    points = chosen.select("grp", F.explode(F.array(*(
        F.struct(F.lit(s + 1).alias("start"), F.array(*(F.col(f"x{s}_{k}") for k in range(P + 2))).alias("xs"))
        for s in range(RANDOM_STARTS)))).alias("e")).select("grp", "e.start", F.explode("e.xs").alias("x")).select("grp", "start", "x.*")
    small = points.groupBy("grp", "start").agg(*_moments())
    estimates = _solve(whole.unionByName(small))
    n_rows = estimates.count()
    for step in range(FIRST_STEPS):
        estimates = _concentrate(rows, estimates, n_rows, keep_best=step == FIRST_STEPS - 1)
    for _ in range(LAST_STEPS):
        estimates = _concentrate(rows, estimates, n_rows, keep_best=False)
    return estimates, n_rows


def judged(docs: DataFrame, tail: float = TAIL, min_group: int = MIN_GROUP) -> DataFrame:
    """doc_id, lang, source, row_hash, the counts, base_failed, distance
    (squared, consistent with the normal; null without an estimate), kept."""
    rows = written(grouped(written(statistics(docs), "quality-stats", texts=True), min_group), "quality-vectors")
    estimates, n_rows = fit(rows)
    # The inner share of a normal sample has too little scatter; this factor mends it.
    factor = SUPPORT / _chi2_cdf(_chi2_quantile(1 - SUPPORT, P), P + 2)
    side = estimates.filter(F.col("n") >= SUPPORT * min_group)
    scored = rows.join(broadcast_if_small(side.withColumnRenamed("grp", "_grp").drop("n", "logdet", "start"), n_rows, 320),
                       F.col("grp").eqNullSafe(F.col("_grp")), "left").withColumn("distance", _distance() / F.lit(factor))
    scored = scored.withColumn("distance", F.when(F.col("m0").isNotNull(), F.col("distance")))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    outlier = F.coalesce(F.col("distance") > F.lit(_chi2_quantile(tail, P)), F.lit(False))
    return scored.select("doc_id", "lang", "source", "row_hash", *COUNTS, base.alias("base_failed"), "distance", (~base & ~outlier).alias("kept"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns as they came."""
    verdicts = judged(docs).filter("kept").select(F.col("doc_id").alias("_id"), F.col("row_hash").alias("_hash")).distinct()
    doc_id = F.col("doc_id").cast("bigint")
    rows = packed(docs, doc_id=doc_id, row_hash=F.xxhash64(doc_id, *(F.col(c).cast("string") for c in ("text", "lang", "source"))))
    return rows.join(verdicts, same([F.col("doc_id"), F.col("row_hash")], [F.col("_id"), F.col("_hash")]), "left_semi").select("row.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "documents")).select("doc_id", *COUNTS, "base_failed", "kept", "distance")
