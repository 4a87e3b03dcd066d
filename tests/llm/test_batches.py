import os

import public_tokenizers
import pyarrow.dataset as ds
from helpers import documents, prose

from protoclass.llm import chosen_path, quality_rules, token_files
from protoclass.llm.common import TEXTS_A_BATCH, text_batches

ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_workers_get_few_texts_at_once(spark, monkeypatch, workdir):
    most = TEXTS_A_BATCH

    def checked(name, run):
        def wrapped(batches):
            def few():
                for b in batches:
                    assert "text" not in b.schema.names or b.num_rows <= most, b.num_rows
                    yield b

            yield from run(few())

        return wrapped

    for module in (quality_rules, chosen_path, token_files):
        monkeypatch.setattr(module, "in_worker", checked)
    before = spark.conf.get(ROWS)
    n = 3 * most
    docs = documents(spark, [(7, prose(i // 2, 12)) for i in range(n)]).coalesce(1)
    assert quality_rules.judged(docs).count() == n
    assert chosen_path.classes(docs).count() == n
    assert token_files.token_ids(documents(spark, [(7, "one text")] * n).coalesce(1), path=f"{workdir}/t").count() == n
    assert spark.conf.get(ROWS) == before


def test_a_smaller_batch_stays_and_the_setting_comes_back(spark):
    before = spark.conf.get(ROWS, None)
    assert before is None
    with text_batches(spark):
        assert spark.conf.get(ROWS) == str(TEXTS_A_BATCH)
    assert spark.conf.get(ROWS, None) is None
    for own, within in (("100", "100"), ("0", str(TEXTS_A_BATCH)), ("20000", str(TEXTS_A_BATCH))):
        spark.conf.set(ROWS, own)
        try:
            with text_batches(spark):
                assert spark.conf.get(ROWS) == within
            assert spark.conf.get(ROWS) == own
        finally:
            spark.conf.unset(ROWS)


def test_segments_stand_in_pages_of_bounded_size(spark, workdir):
    """Some segments of one shard: no page holds them all."""
    docs = documents(spark, [(i, prose(i, 80_000)) for i in range(10)])
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        token_files.write_token_files(docs, f"{workdir}/t", public_tokenizers.path("byte_bpe_50k.json"))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    jvm, pages, payload = spark._jvm, 0, 0
    for file in ds.dataset(f"{workdir}/t").files:
        path = jvm.org.apache.hadoop.fs.Path(f"file://{os.path.abspath(file)}")
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromPath(path, spark._jsc.hadoopConfiguration()))
        for block in reader.getFooter().getBlocks():
            column = next(c for c in block.getColumns() if c.getPath().toDotString() == "payload")
            pages += reader.readOffsetIndex(column).getPageCount()
            payload += column.getTotalUncompressedSize()
        reader.close()
    assert payload > 2 << 20 and pages > 1 and payload / pages < 2 << 20
