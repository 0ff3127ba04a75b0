"""Token counts by source, language and tokenizer version, kept as additive totals that signed batches change."""

from __future__ import annotations

import base64
import hashlib
import uuid
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import discard, shared_dir, slices, stored

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pattern that splits text before merges, fixed by the tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
KEYS = ("source", "lang", "tokenizer_version")
INSERT, DELETE, REVISE = "insert", "delete", "revise"
#: Entries of a batch's part, about. A batch has as many parts, by a hash of the id, as a power of two makes of them; what
#: a later batch reads of it are the parts that its documents are in.
PART_ENTRIES = 1 << 16
#: Batches that are read before the next commit puts them together.
MOST_BATCHES = 64
#: Names of batches that stand for others begin so.
COMPACT = "compact-"
ENTRIES = "doc_id string, source string, lang string, tokenizer_version string, n_tokens long, sign long, parts int, bucket int"
TOTALS = "source string, lang string, tokenizer_version string, documents long, tokens long"


class Tokenizer:
    """A rank file, read once on the driver; its version is its name and the start of its digest."""

    def __init__(self, path: str = TOKENIZER, pattern: str = PATTERN):
        with open(path, "rb") as f:
            raw = f.read()
        self.raw, self.pattern = raw, pattern
        self.version = f"{path.rpartition('/')[2].rpartition('.')[0]}-{hashlib.sha256(raw).hexdigest()[:8]}"

    def encoding(self):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in self.raw.splitlines() if line)}
        return tiktoken.Encoding(self.version, pat_str=self.pattern, mergeable_ranks=ranks, special_tokens={})


def count_tokens(docs: DataFrame, tokenizer: Tokenizer, text_col: str = "text") -> DataFrame:
    """docs with n_tokens in place of the text; a null text has none."""
    sent = docs.sparkSession.sparkContext.broadcast(tokenizer)
    others = [c for c in docs.columns if c != text_col]

    def counted(batches):
        enc = sent.value.encoding()
        for batch in batches:
            texts = batch.column(len(others))
            n = np.zeros(len(texts), np.int64)
            for at, part in slices(texts):
                n[at : at + len(part)] = [len(enc.encode_ordinary(t)) if t else 0 for t in part.to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(len(others))), pa.array(n)], [*others, "n_tokens"])

    kinds = dict(docs.dtypes)
    return docs.select(*others, text_col).mapInArrow(counted, ", ".join(f"`{c}` {kinds[c]}" for c in others) + ", n_tokens long")


class Rollup:
    """Totals in a shared folder: entries/<batch> holds a signed row for each change of a document, by a hash of its id,
    totals/<batch> their sums by key, commits/<batch> says that both are whole. A reader adds up committed totals; the
    order is no matter. One writer at a time; readers need not wait."""

    def __init__(self, spark: SparkSession, path: str, tokenizer: Tokenizer | None = None, part_entries: int = PART_ENTRIES):
        self.spark, self.path, self.tokenizer, self.part_entries = spark, path.rstrip("/"), tokenizer or Tokenizer(), part_entries

    def _fs(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{path}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def committed(self) -> list[str]:
        """Batches whose changes count, also those that compact() has put together."""
        fs, p = self._fs("commits")
        return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []

    def _live(self) -> list[str]:
        """Batches that are read: the committed ones less those that another one stands for."""
        done = self.committed()
        joint = [b for b in done if b.startswith(COMPACT)]
        gone = {r["value"] for r in self.spark.read.text([f"{self.path}/commits/{b}" for b in joint]).collect()} if joint else set()
        return [b for b in done if b not in gone]

    def _read(self, kind: str) -> DataFrame | None:
        live = self._live()
        if not live:
            return None
        base = f"{self.path}/{kind}"
        kinds = ENTRIES if kind == "entries" else TOTALS
        return reduce(DataFrame.unionByName, [self.spark.read.schema(kinds).parquet(f"{base}/{b}") for b in live])

    def _mark(self, batch: str, says: list[str]) -> None:
        fs, p = self._fs(f"commits/{batch}")
        out = fs.create(p, True)
        out.write(bytearray("".join(f"{x}\n" for x in says).encode()))
        out.close()

    def _parts(self) -> list[int]:
        """Into how many parts the batches that are read are dealt; powers of two."""
        fs, p = self._fs("entries")
        live = set(self._live())
        found = fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(p, "*/parts=*")) or []
        return sorted({int(s.getPath().getName().partition("=")[2]) for s in found if s.getPath().getParent().getName() in live})

    def _touched(self, keyed: DataFrame, n: int) -> Column:
        """Whether an entry is in a part that documents of keyed, of n rows, are in."""
        counts = self._parts()
        if not counts or n >= counts[-1]:  # a row for each part would name them all
            return F.lit(True)
        own = [r[0] for r in keyed.select(F.pmod(F.xxhash64("doc_id"), F.lit(counts[-1])).cast("int")).distinct().collect()]  # fewer than parts
        return reduce(lambda a, b: a | b, [(F.col("parts") == c) & F.col("bucket").isin(sorted({k % c for k in own})) for c in counts])

    def _write(self, batch: str, entries: DataFrame, n: int) -> None:
        """entries, about n, and their totals; what a broken-off run has left under the name is overwritten."""
        parts = 1 << max(0, (max(n, 1) - 1) // self.part_entries).bit_length()
        bucket = F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int")
        entries.withColumns({"parts": F.lit(parts), "bucket": bucket}).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("parts", "bucket").parquet(f"{self.path}/entries/{batch}")
        sums = self.spark.read.schema(ENTRIES).parquet(f"{self.path}/entries/{batch}").groupBy(*KEYS)
        sums.agg(F.sum("sign").cast("long").alias("documents"), F.sum(F.col("sign") * F.col("n_tokens")).alias("tokens")).write.mode("overwrite").parquet(f"{self.path}/totals/{batch}")

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch once: (op, doc_id, source, lang, text), and seq where a document changes more than once.

        insert sets what a document counts for under the tokenizer's version, whatever it counted for under it before;
        revise does so for a new text, so that its counts under other versions are taken back too; delete takes all of
        them back, and says nothing about documents that are not there. Of several changes of a document the last by
        seq holds, then by tokens; a null seq is the first. A row without an id is a document of its own and can only
        be inserted. Null and empty texts have no tokens, very long ones are counted whole; a null source or lang is a
        key; other columns are not read. A batch that is committed already changes nothing and returns False; one that
        broke off is written anew. Only the parts of entries that the batch's documents are in are read. Where
        MOST_BATCHES are read, they are put together first.
        """
        if not batch or "/" in batch or batch.startswith((COMPACT, "_", ".")):
            raise ValueError(f"a batch has a name without / and does not begin with {COMPACT}, _ or .")
        if batch in self.committed():
            return False
        if len(self._live()) >= MOST_BATCHES:
            self.compact()
        version = self.tokenizer.version
        seq = F.col("seq").cast("long") if "seq" in changes.columns else F.lit(None).cast("long")
        rows = changes.select(F.coalesce("op", F.lit(INSERT)).alias("op"), F.col("doc_id").cast("string").alias("doc_id"), "source", "lang", seq.alias("seq"), F.when(F.col("op") == DELETE, None).otherwise(F.col("text")).alias("text"))
        rows = stored(count_tokens(rows, self.tokenizer), "rollup-counts")
        last = F.max_by(F.struct("op", "source", "lang", "n_tokens"), F.struct("seq", "n_tokens", "op", "source", "lang")).alias("x")
        keyed = rows.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(last).select("doc_id", "x.*")
        loose = rows.filter(F.col("doc_id").isNull() & (F.col("op") != DELETE)).select("doc_id", "op", "source", "lang", "n_tokens")
        new = keyed.unionByName(loose).filter(F.col("op") != DELETE).select("doc_id", "source", "lang", F.lit(version).alias("tokenizer_version"), "n_tokens", F.lit(1).cast("long").alias("sign"))
        old = self._read("entries")
        n = rows.count()
        if old is not None:  # what these documents count for now is taken back
            live = old.filter(self._touched(keyed, n) & F.col("doc_id").isNotNull()).join(keyed.select("doc_id", "op"), "doc_id")
            live = live.filter((F.col("op") != INSERT) | (F.col("tokenizer_version") == version))
            live = live.groupBy("doc_id", *KEYS, "n_tokens").agg(F.sum("sign").alias("s")).filter("s > 0")
            new = new.unionByName(live.select("doc_id", *KEYS, "n_tokens", (-F.col("s")).alias("sign")))
        self._write(batch, new, n)
        discard(rows)
        self._mark(batch, [])
        return True

    def compact(self) -> str | None:
        """Put all live batches together: entries that have come to nothing go, totals stay the same. The name of the new batch."""
        live = self._live()
        old = self._read("entries")
        if old is None:
            return None
        name = f"{COMPACT}{uuid.uuid4().hex}"
        net = old.groupBy("doc_id", *KEYS, "n_tokens").agg(F.sum("sign").alias("sign")).filter("sign != 0")
        self._write(name, net, old.count())
        self._mark(name, live)
        return name

    def totals(self) -> DataFrame:
        """source, lang, tokenizer_version, documents, tokens; keys that have come to nothing are left out."""
        got = self._read("totals")
        if got is None:
            return self.spark.createDataFrame([], TOTALS)
        out = got.groupBy(*KEYS).agg(F.sum("documents").alias("documents"), F.sum("tokens").alias("tokens"))
        return out.filter("documents != 0 or tokens != 0")


def new_rollup(spark: SparkSession, tokenizer: Tokenizer | None = None) -> Rollup:
    return Rollup(spark, f"{shared_dir(spark)}/rollup-{uuid.uuid4().hex}", tokenizer)
