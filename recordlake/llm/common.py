"""What the operators of this subpackage share: tables, scratch tables on the shared folder, word arrays."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that ends a word.
SPACE = r"\x20\x09-\x0D"
#: Bytes of text that are split into words at a time; a longer text is a slice of its own.
SLICE_BYTES = 4 << 20
HASH_KEY = "recordlake-word1"
#: Punctuation that plain() cuts off both ends of a word.
EDGE = ".,;:!?\"'`()[]{}<>*&%$#|~^-_/\\"
_U = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def one_thread(spark: SparkSession) -> None:
    """Matrix products in a task use one thread, since tasks fill the cores already; a setting of the session's own holds."""
    spark.sparkContext.environment.setdefault("OMP_NUM_THREADS", "1")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; where that is unset and Spark runs on this machine alone, a new local one."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        path = f"file://{tempfile.mkdtemp(prefix='spark-')}"
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: lineage ends here, and a lost executor costs a read."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the table that stored() has written, once nothing reads it any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        path = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def released(spark: SparkSession):
    """Within, the shuffle files of a query go when it ends, not when the driver happens to collect its garbage; if they are wanted again, Spark makes them again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, was)


def fresh(df: DataFrame, name: str) -> str:
    """name, or name with underscores before it that no column of df has."""
    while name in df.columns:
        name = f"_{name}"
    return name


def held_out(doc_id: str | Column, folds: int) -> Column:
    """crc32 of the id as text is 0 modulo folds."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % folds == 0, F.lit(False))


def slices(texts: pa.Array):
    """(start, texts) of runs of rows with about SLICE_BYTES of text each."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(texts):
        base = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, base + SLICE_BYTES, side="right")))
        yield at, texts.slice(at, to - at)
        at = to


class Words:
    """The words of some texts: codes into vocab, and where each text's words begin and end. A null text has none."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        texts = texts.take(pa.array(np.arange(len(texts))))  # a copy: kernels misread offsets of some sliced arrays
        texts = pc.fill_null(texts, "")
        if lower:
            texts = pc.ascii_lower(texts)
        lists = pc.ascii_split_whitespace(texts)
        flat = lists.flatten()
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds = bounds - bounds[0]
        coded = flat.dictionary_encode()
        self.vocab = coded.dictionary
        codes = coded.indices.to_numpy(zero_copy_only=False)
        void = pc.index(self.vocab, pa.scalar("", self.vocab.type)).as_py()
        if void >= 0:  # before leading and after trailing white space
            keep = codes != void
            bounds = np.concatenate([[0], np.cumsum(keep)])[bounds]
            codes = codes[keep]
        self.codes, self.bounds, self.void = codes, bounds, void

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word of vocab."""
        return pd.util.hash_array(self.vocab.to_numpy(zero_copy_only=False), hash_key=HASH_KEY, categorize=False)

    def rows(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def plain(words: pa.Array) -> pa.Array:
    """Words in lower case without punctuation at their ends."""
    return pc.utf8_trim(pc.utf8_lower(words), EDGE)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit hashes (splitmix finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n consecutive word hashes; n - 1 shorter than h."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.zeros(m, np.uint64)
        for k in range(n):
            out = out * _U(0x9E3779B97F4A7C15) + h[k : k + m]
    return mix(out)


def as_binary(values: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Runs of values as raw bytes, one binary per run."""
    values = np.ascontiguousarray(values)
    return pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer((bounds * values.itemsize).astype(np.int32)), pa.py_buffer(values)])
