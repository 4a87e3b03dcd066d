"""Operator 11: Merkle dataset manifest by slot pivot.

Every document is a leaf, the digest of its fields. Within a source the leaves
stand in ascending doc_id; a level's nodes are numbered, node ``i`` is child
``i % FANOUT`` of parent ``i / FANOUT``, and conditional aggregates spread each
parent's children into ``FANOUT`` slot columns. The concatenated columns,
hashed, are the parent. One parent row holds all that a proof needs of its
level: without the own slot column the rest are the siblings, in order. The
subroots of the sources are the leaves of one more such tree, whose top is the
root.

Going up, a level has a sixteenth of the rows of the one below, and what is
grouped is (source, parent number): a hot source is spread like any other.
Going down, every parent row is joined to its own path (the siblings above it)
and spreads it to its children, so a document never meets anything but the row
of its run, and the text is read once, by the leaf hash.

Defined results: ``-`` stands for a null in any field; null ids come first in
their source and ties on the id ascend by leaf digest; repeated rows are leaves
of their own; a null source is a source, before all others; a source of one row
is its own subroot; an empty table gives no rows; other columns are not read.
Texts are hashed whole, as UTF-8 bytes, whatever their length.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from protoclass.llm.common import broadcast_if_small, prefix_sums, same, table, written

FANOUT = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: A document is tampered with for the proof check where this divides the crc32 of its id.
TAMPERED_EVERY = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Bytes of a path's entry (its siblings as hex text) and of a key, for the broadcast bound.
_ENTRY_BYTES = 64 * FANOUT + 64


def digest(value: Column) -> Column:
    """Lowercase hex sha256 of a string's bytes."""
    return F.sha2(value, 256)


def _field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(text: Column | None = None) -> Column:
    """The leaf digest of a row of documents, with ``text`` in the place of its text."""
    columns = {c: F.col(c) for c in FIELDS} | ({} if text is None else {"text": text})
    return digest(F.concat(*(_field(columns[c]) for c in FIELDS)))


def _slots() -> list[str]:
    return [f"s{i}" for i in range(FANOUT)]


def _joined(slots: list[str]) -> Column:
    return F.concat(*(F.coalesce(F.col(f"{s}.digest"), F.lit("")) for s in slots)) if slots else F.lit("")


def _parents(nodes: DataFrame) -> DataFrame:
    """grp, idx, n, digest, s0 .. of the parents of ``nodes`` (grp, idx, n, node)."""
    parent, slot = F.expr(f"idx div {FANOUT}"), F.col("idx") % FANOUT
    spread = [F.max(F.when(slot == i, F.col("node"))).alias(s) for i, s in enumerate(_slots())]
    rows = nodes.groupBy("grp", parent.alias("idx"), F.expr(f"(n + {FANOUT - 1}) div {FANOUT}").alias("n")).agg(*spread)
    return rows.select("grp", "idx", "n", digest(_joined(_slots())).alias("digest"), *_slots())


def _climb(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame, int]:
    """(the levels' parents from the lowest up, grp and digest of every group's
    top, number of groups). ``n`` is the number of the group's nodes at a level."""
    levels, tops = [], []
    most, groups = nodes.agg(F.max("n"), F.count(F.when(F.col("idx") == 0, 1))).first()
    most = most or 0
    while True:
        tops.append(nodes.filter("n = 1").select("grp", F.col("node.digest").alias("digest")))
        if most <= 1:
            return levels, reduce(DataFrame.unionByName, tops), groups
        level = written(_parents(nodes.filter("n > 1")), f"{name}-{len(levels)}")
        levels.append(level)
        nodes = level.select("grp", "idx", "n", F.struct("digest").alias("node"))
        most = -(-most // FANOUT)


def _children(parents: DataFrame) -> DataFrame:
    """grp, idx, node, path of every child: the own siblings before the parent's path."""
    slots = _slots()
    each = F.array(*(F.struct(F.lit(i).alias("slot"), F.col(s).alias("node"), _joined(slots[:i]).alias("left"), _joined(slots[i + 1 :]).alias("right"))
                     for i, s in enumerate(slots)))
    rows = parents.select("grp", "idx", "path", F.explode(F.filter(each, lambda x: x["node"].isNotNull())).alias("c"))
    return rows.select("grp", (F.col("idx") * FANOUT + F.col("c.slot")).alias("idx"), F.col("c.node").alias("node"),
                       F.concat(F.array(F.struct("c.left", "c.right")), F.col("path")).alias("path"))


def _descend(levels: list[DataFrame], tops: DataFrame, groups: int, depth_above: int) -> DataFrame:
    """grp, idx, node, path for the nodes below the lowest of ``levels``;
    ``tops`` has grp and the path of every group's top."""
    tops = tops.select(F.col("grp").alias("_grp"), F.col("path").alias("_path"))
    small_tops = broadcast_if_small(tops, groups, _ENTRY_BYTES * (depth_above + 1))
    children = None
    for level in reversed(levels):
        top_rows = level.filter("n = 1").join(small_tops, same([F.col("grp")], [F.col("_grp")])).drop("_grp").withColumnRenamed("_path", "path")
        rows = top_rows
        if children is not None:
            above = children.select(F.col("grp").alias("_grp"), F.col("idx").alias("_idx"), "path")
            inner = level.filter("n > 1").join(above, same([F.col("grp"), F.col("idx")], [F.col("_grp"), F.col("_idx")])).drop("_grp", "_idx")
            rows = top_rows.unionByName(inner)
        children = _children(rows)
    return children


def _numbered(nodes: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """Adds idx, the place of a row in its group."""
    return prefix_sums(nodes.withColumn("_one", F.lit(1).cast("bigint")), group, order, "_one", "idx", name).drop("_one")


def manifest(docs: DataFrame, tampered: Column, tampered_text: Column) -> DataFrame:
    """doc_id, source, leaf, subroot, root, proof (array of the left and right
    siblings of every level) and other (the leaf with ``tampered_text`` where
    ``tampered``, else the leaf) for every document."""
    leaves = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf().alias("leaf"),
                         F.when(tampered, leaf(tampered_text)).alias("other"))
    leaves = written(leaves, "merkle-leaves")
    placed = _numbered(leaves, ["source"], [F.col("doc_id").asc_nulls_first(), F.col("leaf")], "merkle-placed")
    sizes = written(placed.groupBy("source").agg(F.count("*").alias("n")), "merkle-sources")
    sources = sizes.count()
    sizes = sizes.select(F.col("source").alias("_source"), "n")
    nodes = placed.join(broadcast_if_small(sizes, sources, 128), same([F.col("source")], [F.col("_source")]))
    nodes = nodes.select(F.col("source").alias("grp"), "idx", "n", F.struct(F.col("leaf").alias("digest"), "doc_id", "other").alias("node"))

    levels, subroots, _ = _climb(nodes, "merkle-level")
    subroots = written(subroots.withColumnRenamed("grp", "source"), "merkle-subroots")
    numbered = _numbered(subroots, [], [F.col("source").asc_nulls_first()], "merkle-numbered")
    upper = numbered.select(F.lit(0).alias("grp"), "idx", F.lit(sources).cast("bigint").alias("n"), F.struct("digest", "source").alias("node"))
    upper_levels, root, _ = _climb(upper, "merkle-top")
    no_path = F.expr("cast(array() as array<struct<left:string,right:string>>)")
    if upper_levels:
        over = _descend(upper_levels, root.select("grp", no_path.alias("path")), 1, 0).select("node", "path")
    else:
        over = upper.select("node", no_path.alias("path"))
    top = root.first()  # one digest; none of an empty table
    over = written(over.select(F.col("node.source").alias("grp"), F.col("node.digest").alias("subroot"),
                               F.lit(top["digest"] if top else None).cast("string").alias("root"), "path"), "merkle-over")

    tops = over.select("grp", "path")
    alone = nodes.filter("n = 1").select("grp", "node").join(
        broadcast_if_small(tops.withColumnRenamed("grp", "_grp"), sources, _ENTRY_BYTES * (len(upper_levels) + 1)), same([F.col("grp")], [F.col("_grp")])).drop("_grp")
    rows = alone
    if levels:
        rows = _descend(levels, tops, sources, len(upper_levels)).select("grp", "node", "path").unionByName(alone)
    ends = over.select(F.col("grp").alias("_grp"), "subroot", "root")
    rows = rows.join(broadcast_if_small(ends, sources, 256), same([F.col("grp")], [F.col("_grp")]))
    return rows.select(F.col("node.doc_id").alias("doc_id"), F.col("grp").alias("source"), F.col("node.digest").alias("leaf"), "subroot", "root",
                       F.col("path").alias("proof"), F.coalesce("node.other", "node.digest").alias("other"))


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return digest(F.array_join(F.transform(proof, lambda x: F.concat(x["left"], x["right"])), ""))


def folded(start: Column, proof: Column) -> Column:
    """The root that a leaf and its proof lead to."""
    return F.aggregate(proof, start, lambda acc, x: digest(F.concat(x["left"], acc, x["right"])))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % TAMPERED_EVERY == 0
    rows = manifest(table(spark, sf_dir, "documents"), tampered, F.translate("text", _UPPER, _LOWER))
    rows = rows.withColumn("folded_root", folded(F.col("other"), F.col("proof")))
    return rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
                       (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql() -> str:
    """DuckDB SQL: the tree level by level, numbers by window functions, proofs by joins."""
    crc_byte = ("list_reduce(range(8), lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, xor(acc, b))")
    crc = f"xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT)), lambda acc, b: {crc_byte}, CAST(4294967295 AS BIGINT)), 4294967295)"
    field = lambda c: f"coalesce(CAST(strlen(CAST({c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"
    lower = f"translate(text, '{_UPPER}', '{_LOWER}')"
    plain, changed = (f"sha256({' || '.join([*map(field, FIELDS[:-1]), field(t)])})" for t in ("text", lower))
    parts = [f"""
docs AS (SELECT doc_id, source, {plain} AS leaf, CASE WHEN {crc} % {TAMPERED_EVERY} = 0 THEN {changed} END AS other FROM documents),
a0 AS (SELECT row_number() OVER () AS id, *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, leaf AS digest,
       count(*) OVER (PARTITION BY source) AS n, '' AS proof, coalesce(other, leaf) AS fold FROM docs)"""]

    def level(frm: str, to: str, grp: str) -> str:
        same_run = f"x.idx // {FANOUT} = y.idx // {FANOUT} AND x.{grp} IS NOT DISTINCT FROM y.{grp}"
        return f""",
{to}n AS MATERIALIZED (SELECT DISTINCT {grp}, idx, n, digest FROM {frm}),
{to}p AS MATERIALIZED (SELECT x.{grp}, x.idx, any_value(x.n) AS n, coalesce(string_agg(y.digest, '' ORDER BY y.idx) FILTER (y.idx < x.idx), '') AS l,
        coalesce(string_agg(y.digest, '' ORDER BY y.idx) FILTER (y.idx > x.idx), '') AS r, any_value(x.digest) AS own FROM {to}n x JOIN {to}n y ON {same_run} GROUP BY ALL),
{to} AS MATERIALIZED (SELECT t.* REPLACE (CASE WHEN p.n > 1 THEN t.idx // {FANOUT} ELSE t.idx END AS idx, CASE WHEN p.n > 1 THEN (p.n + {FANOUT - 1}) // {FANOUT} ELSE p.n END AS n,
        CASE WHEN p.n > 1 THEN sha256(p.l || p.own || p.r) ELSE t.digest END AS digest, CASE WHEN p.n > 1 THEN t.proof || p.l || p.r ELSE t.proof END AS proof,
        CASE WHEN p.n > 1 THEN sha256(p.l || t.fold || p.r) ELSE t.fold END AS fold)
        FROM {frm} t JOIN {to}p p ON t.idx = p.idx AND t.{grp} IS NOT DISTINCT FROM p.{grp})"""

    depth = 6  # 16^6 rows a source, and as many sources
    for i in range(depth):
        parts.append(level(f"a{i}", f"a{i + 1}", "source"))
    parts.append(f""",
tops AS (SELECT DISTINCT source, digest FROM a{depth}),
places AS (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS many FROM tops),
b0 AS (SELECT a.* REPLACE (place AS idx, many AS n), a.digest AS subroot, 0 AS one FROM a{depth} a JOIN places p ON a.source IS NOT DISTINCT FROM p.source)""")
    for i in range(depth):
        parts.append(level(f"b{i}", f"b{i + 1}", "one"))
    return f"WITH{''.join(parts)}\nSELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = digest AS verified FROM b{depth}"


OP11_SQL = _sql()
