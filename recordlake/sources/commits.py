"""Tables whose partitions are replaced as wholes, also by nothing.

Data lies in folders of batches. A snapshot says which batch holds each partition and how many rows; the newest is the
one that the file with the highest number in _commits names. That file is renamed into place once the batch and the
snapshot are there, and never over another one: a write that breaks off leaves what was there, and of two that finish at
once one is told so and builds its snapshot again.
"""

from __future__ import annotations

import json
import uuid

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows of snapshots that are broadcast; more are joined by shuffle.
FEW_PARTS = 100_000
#: Snapshots that are built before a commit gives up against others.
TRIES = 20


def local_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows of the driver as a table of the plan itself, without Python workers."""
    kind = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(kind)
    columns = list(zip(*rows, strict=True)) if rows else [() for _ in arrow]
    return spark.createDataFrame(pa.table([pa.array(list(c), f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow), kind)


class Conflict(Exception):
    """Others have committed first, again and again."""


class Commits:
    """Partitions by part (a column of the caller's), period and file below a folder."""

    def __init__(self, spark: SparkSession, path: str, part: str):
        self.spark, self.path, self.part = spark, path.rstrip("/"), part
        self.schema = f"batch string, batch_size long, {part} string, period string, file string, n long, source string"

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _put(self, path: str, content: dict) -> bool:
        """Write a file under another name and rename it; False if there is one of this name."""
        jvm = self.spark._jvm
        p, fs = self._fs(path)
        tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{uuid.uuid4().hex}")
        out = fs.create(tmp, False)
        out.write(bytearray(json.dumps(content).encode()))
        out.close()
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(tmp), fs.makeQualified(p), options)
        except (Py4JJavaError, PySparkException) as e:
            fs.delete(tmp, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    def _get(self, path: str) -> dict:
        p, fs = self._fs(path)
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def numbers(self) -> list[int]:
        p, fs = self._fs(f"{self.path}/_commits")
        return sorted(int(s.getPath().getName()) for s in fs.listStatus(p) if s.getPath().getName().isdigit()) if fs.exists(p) else []

    def latest(self, number: int | None = None) -> dict:
        """What the newest commit, or that of a number, says: number, snapshot, batches, streams (the last batch of each)."""
        have = self.numbers()
        if not have:
            return {"number": 0, "snapshot": None, "batches": [], "streams": {}}
        return self._get(f"{self.path}/_commits/{have[-1] if number is None else number:012d}")

    def entries(self, at: dict | None = None) -> DataFrame:
        """batch, batch_size, part, period, file, n, source of each partition: what holds it, its rows and what it was made of."""
        at = at or self.latest()
        if at["snapshot"] is None:
            return local_frame(self.spark, [], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/_snapshots/{at['snapshot']}")

    def columns(self, batch: str) -> dict:
        return self._get(f"{self.path}/_columns/{batch}")

    def commit(self, batch: str, entries: list[tuple], replaced: list[tuple], columns: dict | None = None, stream: tuple[str, int] | None = None, written: int = 0) -> int:
        """The number under which a batch's partitions are there. entries: (part, period, file, n, source), metadata of the driver.

        replaced: (file, wanted, known): partitions of the file go if their part is in wanted, or not in known (a null list
        of known spares the parts that wanted does not name). With a stream's name and batch id a batch is committed once.
        written: partitions that the batch's folder has, if it has more than entries with rows.
        """
        if columns is not None:
            self._put(f"{self.path}/_columns/{batch}", columns)
        size = max(sum(1 for e in entries if e[3]), written)  # partitions without rows lie nowhere
        new = local_frame(self.spark, [(batch, size, *e) for e in entries], self.schema)
        gone = local_frame(self.spark, replaced, "file string, wanted array<string>, known array<string>")
        gone = F.broadcast(gone) if len(replaced) <= FEW_PARTS else gone
        for _ in range(TRIES):
            at = self.latest()
            if stream and at["streams"].get(stream[0], -1) >= stream[1]:
                return at["number"]
            old = self.entries(at).join(gone, "file", "left")
            hit = F.array_contains("wanted", F.col(self.part)) | ~F.array_contains("known", F.col(self.part))
            kept = old.filter(F.col("wanted").isNull() | ~F.coalesce(hit, F.lit(False))).drop("wanted", "known")
            name = f"{at['number'] + 1:012d}-{uuid.uuid4().hex}"
            kept.unionByName(new).coalesce(max(1, len(entries) // FEW_PARTS)).write.parquet(f"{self.path}/_snapshots/{name}")
            counts = self.spark.read.schema(self.schema).parquet(f"{self.path}/_snapshots/{name}").groupBy("batch").agg(F.count_if(F.col("n") > 0).alias("c"), F.first("batch_size").alias("size")).collect()  # a row for each batch
            said = {"number": at["number"] + 1, "snapshot": name, "batches": [[r["batch"], r["c"] == r["size"]] for r in sorted(counts)], "streams": at["streams"] | ({stream[0]: stream[1]} if stream else {})}
            if self._put(f"{self.path}/_commits/{said['number']:012d}", said):
                return said["number"]
        raise Conflict(self.path)

    def alive(self, rows: DataFrame, at: dict, keys: tuple[str, ...], part: str | None = None) -> DataFrame:
        """rows (with the column batch) of the partitions that a commit names; part: that of all rows, if they do not say it."""
        rows = rows.filter(F.col("batch").isin([b for b, _ in at["batches"]]))
        if all(whole for _, whole in at["batches"]):
            return rows
        have = self.entries(at).filter("n > 0")
        have = (have if part is None else have.filter(F.col(self.part) == part)).select("batch", *keys).distinct()
        few = have.limit(FEW_PARTS + 1).count() <= FEW_PARTS
        return rows.join(F.broadcast(have) if few else have, ["batch", *keys], "left_semi")

    def vacuum(self, keep: int = 2) -> list[str]:
        """Remove batches that none of the newest commits names, and older commits; the batches removed. No writer may be at work."""
        have = self.numbers()
        kept = [self.latest(n) for n in have[-keep:]]
        used = {b for at in kept for b, _ in at["batches"]}
        every = {b for n in have for b, _ in self.latest(n)["batches"]}
        p, fs = self._fs(self.path)
        Path = self.spark._jvm.org.apache.hadoop.fs.Path
        for pattern in ("batch=*", "*/batch=*"):
            for s in fs.globStatus(Path(p, pattern)) or []:
                batch = s.getPath().getName().removeprefix("batch=")
                if batch not in used:
                    every.add(batch)
                    fs.delete(s.getPath(), True)
        for n in have[:-keep]:
            fs.delete(Path(p, f"_snapshots/{self.latest(n)['snapshot']}"), True)
            fs.delete(Path(p, f"_commits/{n:012d}"), False)
        for batch in every - used:
            fs.delete(Path(p, f"_columns/{batch}"), False)
        return sorted(every - used)


def counted(rows: DataFrame, code: str, codes: int, chunk: int = 256):
    """(rows, a function that says how many rows each code from 0 to codes - 1 had, once rows have been written).

    The counts come out of the job that writes. A histogram with a bin for each value is exact: bins of equal values are
    merged first, and there are never more values than bins.
    """
    from pyspark.sql import Observation

    seen = Observation()
    parts = [F.histogram_numeric(F.when((F.col(code) >= a) & (F.col(code) < a + chunk), F.col(code).cast("double")), F.lit(chunk)).alias(f"h{a}") for a in range(0, max(codes, 1), chunk)]
    rows = rows.observe(seen, *parts)

    def counts() -> dict[int, int]:
        out: dict[int, int] = {}
        for bins in seen.get.values():
            for b in bins or []:
                k = round(b["x"])
                out[k] = out.get(k, 0) + round(b["y"])
        return out

    return rows, counts
