import hashlib
import zlib
from collections import defaultdict
from itertools import batched

import duckdb
from helpers import clashing, documents
from pyspark.sql import functions as F

from protoclass.llm.merkle_manifest import folded, manifest, proof_digest
from protoclass.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def climb(digests, proofs):
    """The top of a tree over (digest, rows below it); adds to each row's proof."""
    nodes = digests
    while len(nodes) > 1:
        above = []
        for run in batched(nodes, 16):
            for i, (_, below) in enumerate(run):
                for r in below:
                    proofs[r].append(("".join(d for d, _ in run[:i]), "".join(d for d, _ in run[i + 1 :])))
            above.append((h(*(d for d, _ in run)), [r for _, below in run for r in below]))
        nodes = above
    return nodes[0]


def brute(rows):
    """doc_id, leaf, subroot, root, proof digest, folded root, verified of every row."""
    proofs, by_source = defaultdict(list), defaultdict(list)
    leaves = [leaf(r, r["text"]) for r in rows]
    for i, r in enumerate(rows):
        by_source[r["source"]].append(i)
    tops = []
    for source in sorted(by_source, key=lambda s: (s is not None, (s or "").encode())):
        ids = sorted(by_source[source], key=lambda i: (rows[i]["doc_id"] is not None, rows[i]["doc_id"] or 0, leaves[i]))
        tops.append(climb([(leaves[i], [i]) for i in ids], proofs))
    subroot = {i: d for d, below in tops for i in below}
    root = climb(tops, proofs)[0]
    out = []
    for i, r in enumerate(rows):
        start = leaves[i]
        if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and r["text"] is not None:
            start = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"]))
        for left, right in proofs[i]:
            start = h(left, start, right)
        out.append((r["doc_id"], leaves[i], subroot[i], root, h(*(a + b for a, b in proofs[i])), start, start == root))
    return sorted(out, key=str)


def result(docs):
    rows = manifest(docs, F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    rows = rows.withColumn("f", folded(F.col("other"), F.col("proof")))
    return sorted((tuple(r) for r in rows.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("proof")), "f", F.col("f") == F.col("root")).collect()), key=str)


def check(spark, rows):
    docs = documents(spark, rows)
    assert result(clashing(docs.repartition(5), "idx", "grp", "n", "node", "digest", "_source", "path")) == brute([r.asDict() for r in docs.collect()])


def test_sources_of_many_sizes(spark):
    rows = [(f"{n}", n) for n in (1, 2, 15, 16, 17, 31, 256, 257, 300)]
    rows = [(i * 7 - 50, f"Text {name} {i} Ünï", "en", f"s{name}") for name, n in rows for i in range(n)]
    check(spark, rows)


def test_many_sources(spark):
    check(spark, [(i, f"T{i}", None, f"é{i % 290}" if i % 290 else None) for i in range(330)])


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(1, "A b"), (1, "A b"), (1, "C"), (None, "X"), (None, None), (5, None), (5, ""), (9, "-"), (10, "q" * 200_000, None, None), (2, "Only", "en", "")]
    check(spark, rows)


def test_one_source_one_row_no_row(spark):
    check(spark, [(5, "Alone")])
    check(spark, [(i, "Alone Again") for i in range(40)])
    assert result(documents(spark, [])) == []


def test_query_on_whole_table(spark):
    path = f"{SF}/documents.parquet"
    got = sorted((tuple(r) for r in QUERIES["op11_merkle_manifest"](spark, SF).collect()), key=str)
    assert got == brute([r.asDict() for r in spark.read.parquet(path).collect()])
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}'")
    assert sorted(con.execute(ORACLE_SQL["op11_merkle_manifest"]).fetchall(), key=str) == got
    assert len({r[6] for r in got}) == 2
