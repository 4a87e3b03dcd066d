"""Small document tables for the tests of this folder."""

from __future__ import annotations

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows):
    """rows: (doc_id, text[, lang[, source]])."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(seed: int, n: int, vocabulary: int = 2000) -> str:
    rng = random.Random(seed)
    words = [f"w{rng.randrange(vocabulary)}x" for _ in range(n)]
    return "".join(w + ("\n" if i % 12 == 11 else " ") for i, w in enumerate(words)).strip()


def clashing(df, *names):
    """``df`` with further columns of names that operators use inside."""
    from pyspark.sql import functions as F

    return df.withColumns({n: F.lit(f"own {n}") for n in names})
