"""Documents of invented words, with copies, near copies, empty and long texts."""

from __future__ import annotations

import random
import re

from pyspark.sql import DataFrame, SparkSession

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, spans string, bucket int"


def words(rng: random.Random, n: int, size: int = 400) -> list[str]:
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def frame(spark: SparkSession, rows: list[tuple], partitions: int = 3) -> DataFrame:
    """Rows (doc_id, text) with the other columns of documents and some whose names operators use inside; from a file."""
    full = [(i, t, "en", "s" if (i or 0) % 3 else "hot", len(t or ""), "k", "x", 1) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(partitions) if full else spark.createDataFrame([], SCHEMA)


def table(spark: SparkSession, tmp_path, rows: list[tuple], name: str = "documents") -> DataFrame:
    path = f"{tmp_path}/{name}.parquet"
    frame(spark, rows).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def corpus(seed: int = 0, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    rows: list[tuple] = []
    for i in range(n):
        rows.append((i, " ".join(words(rng, rng.choice([3, 30, 80, 200])))))
    base = words(rng, 120)
    for k in range(12):  # near copies and copies of one text
        w = list(base)
        for _ in range(k % 4):
            w[rng.randrange(len(w))] = "zz"
        rows.append((n + k, " ".join(w)))
    shared = " ".join(words(rng, 60))
    for k in range(6):  # a passage that several texts share
        rows.append((n + 20 + k, " ".join(words(rng, 40)) + " \n\t" + shared + "  " + " ".join(words(rng, 40))))
    rows += [(n + 40, None), (n + 41, ""), (n + 42, " \n "), (n + 43, "one two"), (n + 44, "one two"), (n + 45, " ".join(words(rng, 9000))), (None, "a null id " + shared), (n + 46, "la " * 200), (n + 47, "é ñ \xa0x  y"), (n + 48, "é ñ \xa0x  y")]
    rows.append(rows[5])  # a row given again
    return rows
