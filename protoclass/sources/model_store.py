"""B1/B2: a fitted model as Parquet tables, and back.

Layout under ``path``: ``factors/`` (term, df, q), ``sums/`` (topic, term,
sw), ``vocabulary/`` (topic, n_train), ``topic_norms/`` (topic, n2) and
``meta/`` (one row: corpus size and the settings the model was fitted with).
Large tables are written by the executors; nothing passes through the
driver except the one meta row.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from ..plans.pipeline import CentroidModel, Config, model_of
from ..session import materialize

_TABLES = ("factors", "sums", "vocabulary", "topic_norms")


def save_model(model: CentroidModel, path: str) -> None:
    base = path.rstrip("/")
    model.factors.write.mode("errorifexists").parquet(f"{base}/factors")
    model.sums.write.mode("errorifexists").parquet(f"{base}/sums")
    model.vocabulary.write.mode("errorifexists").parquet(f"{base}/vocabulary")
    model.topic_norms.write.mode("errorifexists").parquet(f"{base}/topic_norms")
    cfg = model.config
    meta = {
        "n_docs": model.n_docs,
        "profile": cfg.profile, "stop_words": list(cfg.stop_words), "df_scope": cfg.df_scope,
        "exact": cfg.exact, "topic_block": cfg.topic_block, "prune": cfg.prune, "tail_share": cfg.tail_share,
        "max_broadcast_bytes": cfg.max_broadcast_bytes, "order": list(cfg.order), "unique_order": cfg.unique_order, "rebalance": cfg.rebalance,
        "max_token_length": cfg.max_token_length, "task_rows": cfg.task_rows,
    }
    spark = model.factors.sparkSession
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1) \
        .write.mode("errorifexists").json(f"{base}/meta")


def load_model(spark: SparkSession, path: str, keep: str = "persist") -> CentroidModel:
    base = path.rstrip("/")
    meta = json.loads(spark.read.json(f"{base}/meta").select("meta").first()["meta"])
    cfg = Config(profile=meta["profile"], stop_words=tuple(meta["stop_words"]), df_scope=meta["df_scope"],
                 exact=meta["exact"], topic_block=meta["topic_block"], prune=meta["prune"], tail_share=meta["tail_share"],
                 max_broadcast_bytes=meta["max_broadcast_bytes"], order=tuple(meta["order"]), unique_order=meta["unique_order"],
                 rebalance=meta["rebalance"], max_token_length=meta["max_token_length"],
                 task_rows=meta["task_rows"], keep=keep)
    tables = {name: spark.read.parquet(f"{base}/{name}") for name in _TABLES}
    factors, sums = materialize(tables["factors"], keep), materialize(tables["sums"], keep)
    return model_of(int(meta["n_docs"]), factors, sums, tables["vocabulary"], tables["topic_norms"], cfg, [factors, sums])
