"""Exact deduplication by an extendible-hash index kept as files in the shared folder. DataFrame functions only."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import fresh, shared_dir, stored

#: Entries that a bucket holds before it is split.
BUCKET_KEYS = 128
#: Keys that a page of the index has on average: a range of keys, its directory and its buckets.
PAGE_KEYS = 4096
#: A page that more rows than this, and than one in HOT_SHARE of all, look up is there several times.
HOT_ROWS, HOT_SHARE = 2 * PAGE_KEYS, 1000
#: Keys of chains of more than one that are broadcast; more are joined by shuffle.
FEW_CHAINED = 10_000
#: Turns keys so that they sort as if they had no sign.
_SIGN = -(1 << 63)


def _first_bits(key: str, bits: str) -> Column:
    """The first bits of a key, as a number; none for no bits."""
    return F.expr(f"CASE WHEN {bits} = 0 THEN 0L ELSE shiftrightunsigned({key}, 64 - {bits}) END")


def _page(bits: int) -> Column:
    return F.shiftrightunsigned("h", 64 - bits) if bits else F.lit(0).cast("long")


def pages(entries: DataFrame, bits: int, owners: int, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """page_no, rows, starts, buckets: the index of entries (h, sha, keep_id, group_size), a row for each page.

    A page has the keys that begin with the same bits. Owner tasks have ranges of keys, some pages each: entries of one
    key make a chain, and the page's directory doubles as long as a bucket has more than bucket_keys entries, which is
    then split by its next bit. Where the entries of a page are sorted, this can be told at once: bucket_keys + 1
    neighbours that share n bits must be told apart by more than n. So a bucket is as deep as the most that the
    neighbours around its keys ask for, without a limit; a chain that is longer has a bucket of its own. starts is the directory: slots that lead to the same bucket are one run, told by its start.
    """
    own = entries.withColumns({"page_no": _page(bits), "u": F.col("h").bitwiseXOR(F.lit(_SIGN))}).repartition(owners, "page_no")
    sorted_ = Window.partitionBy("page_no").orderBy("u", "sha")
    apart = F.col("h").bitwiseXOR(F.lead("h", bucket_keys).over(sorted_))
    own = own.withColumn("deeper", F.when(apart == 0, 64).otherwise(65 - F.length(F.bin(apart))))
    local = F.greatest(F.coalesce(F.max("deeper").over(sorted_.rowsBetween(-bucket_keys, 0)), F.lit(0)), F.lit(bits)).cast("int")
    chain = F.array_sort(F.collect_list(F.struct("sha", "keep_id", "group_size")))
    keys = own.withColumn("local", local).groupBy("page_no", "h", "u").agg(F.max("local").alias("local"), chain.alias("chain"), F.sum("group_size").alias("rows"))
    start = F.expr("CASE WHEN local = 0 THEN 0L ELSE shiftleft(shiftrightunsigned(h, 64 - local), 64 - local) END").bitwiseXOR(F.lit(_SIGN))
    each = F.array_sort(F.collect_list(F.struct("u", "h", "chain")))
    buckets = keys.groupBy("page_no", start.alias("start")).agg(F.first("local").alias("local"), each.alias("k"), F.sum("rows").alias("rows"))
    bucket = F.struct("start", "local", F.transform("k", lambda x: x["h"]).alias("keys"), F.transform("k", lambda x: x["chain"]).alias("chains"))
    out = buckets.groupBy("page_no").agg(F.sum("rows").alias("rows"), F.array_sort(F.collect_list(bucket)).alias("buckets"))
    return out.select("page_no", "rows", F.transform("buckets", lambda b: b["start"]).alias("starts"), "buckets")


class Index:
    """The pages as files of owners in the shared folder, and lookups in them.

    Pages are dealt to owners by number, and the table says so: rows that look a key up are sent to the owner of its page,
    and the pages are read where they lie. A page that many rows ask for, because a text has many copies, is there
    several times, and rows take turns.
    """

    def __init__(self, entries: DataFrame, bucket_keys: int = BUCKET_KEYS, page_bits: int | None = None):
        spark = entries.sparkSession
        total = entries.agg(F.count(F.lit(1)).alias("keys"), F.coalesce(F.sum("group_size"), F.lit(0)).alias("rows")).first()
        self.bits = page_bits if page_bits is not None else math.ceil(math.log2(total["keys"] / PAGE_KEYS)) if total["keys"] > PAGE_KEYS else 0
        self.owners = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        most = max(HOT_ROWS, total["rows"] // HOT_SHARE)
        built = pages(entries, self.bits, self.owners, bucket_keys).withColumn("times", F.ceil(F.col("rows") / most).cast("int"))
        name = f"dedup_index_{uuid.uuid4().hex}"
        dealt = built.withColumn("turn", F.explode(F.sequence(F.lit(0), F.col("times") - 1))).repartition(self.owners, "page_no", "turn")
        dealt.write.bucketBy(self.owners, "page_no", "turn").format("parquet").option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
        self.table = spark.table(name)
        self.hot = stored(self.table.filter("times > 1 AND turn = 0").select("page_no", "times"), "dedup-hot")  # fewer than HOT_SHARE

    def look_up(self, rows: DataFrame) -> DataFrame:
        """rows (with the key h) with bucket, its number, and chain, the entries of the key. The page's directory says in which bucket to look."""
        asked = rows.withColumn("page_no", _page(self.bits)).join(F.broadcast(self.hot), "page_no", "left")
        asked = asked.withColumn("turn", F.pmod(F.monotonically_increasing_id(), F.coalesce("times", F.lit(1))).cast("int")).drop("times")
        met = asked.join(self.table.select("page_no", "turn", "starts", "buckets"), ["page_no", "turn"])
        u = F.col("h").bitwiseXOR(F.lit(_SIGN))
        found = F.get("buckets", F.size(F.filter("starts", lambda s: s <= u)) - 1)
        chain = F.get(found["chains"], F.array_position(found["keys"], F.col("h")).cast("int") - 1)
        out = met.select(*rows.columns, found["local"].alias("_local"), chain.alias("chain")).filter("chain IS NOT NULL")
        number = F.expr("CASE WHEN _local > 62 THEN h ELSE shiftleft(1L, _local) END").bitwiseOR(_first_bits("h", "_local"))
        return out.withColumn("bucket", number).drop("_local")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bucket_keys: int = BUCKET_KEYS, top_bits: int | None = None, hash_bits: int = 64) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, bucket, chain of each row: texts are equal when their bytes are.

    The key is a hash of the text, its first hash_bits bits. Copies are merged before the only shuffle that texts go
    through, by key and bytes, so that a text with any number of copies costs a row per map task. Owner tasks build the
    Index over the distinct texts, pages of top_bits bits. Every row then looks its key up with the owner of its page, in
    the bucket that the directory says. A chain of one entry is the row's own, since the row is in the index; in longer
    chains, where keys collide, bytes are compared.

    A null text counts as empty. A null id is less than any other; rows of null ids only have keep_id null and say
    kept. Rows that repeat an id and its text are one document given again and get equal rows. Very long texts are
    compared whole. Other columns are not read, whatever their names. No rows give no rows.
    """
    key = F.xxhash64("text") if hash_bits == 64 else F.shiftleft(F.shiftrightunsigned(F.xxhash64("text"), 64 - hash_bits), 64 - hash_bits)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("h", key)
    merged = rows.groupBy("h", "text").agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    merged = stored(merged.select("h", F.unhex(F.sha2("text", 256)).alias("sha"), "keep_id", "group_size"), "dedup-texts")
    index = Index(merged, bucket_keys, top_bits)
    out = ("doc_id", "keep_id", "group_size", "sha", "bucket", "place")
    met = index.look_up(rows.select("doc_id", "h")).filter(F.size("chain") == 1)
    found = met.select("doc_id", F.get("chain", F.lit(0)).alias("e"), "bucket", F.lit(1).alias("place")).select("doc_id", "e.keep_id", "e.group_size", "e.sha", "bucket", "place")
    buckets = index.table.filter("turn = 0").select(F.explode("buckets").alias("b")).select(F.col("b.keys").alias("h"), F.col("b.chains").alias("chain"))
    collided = stored(buckets.select(F.explode(F.arrays_zip("h", "chain")).alias("k")).filter(F.size("k.chain") > 1).select("k.h"), "dedup-collided")
    few = collided.limit(FEW_CHAINED + 1).count()
    if few:  # the bytes of the texts whose keys collide, which are so few that they can mostly be sent to where the rows are
        texts = rows.join(F.broadcast(collided) if few <= FEW_CHAINED else collided, "h", "left_semi")
        same = texts.select("h", "text").distinct().withColumn("sha", F.unhex(F.sha2("text", 256)))
        met = index.look_up(texts.join(same, ["h", "text"]).select("doc_id", "h", "sha"))
        place = F.array_position(F.transform("chain", lambda e: e["sha"]), F.col("sha")).cast("int")
        met = met.select("doc_id", F.get("chain", place - 1).alias("e"), "bucket", place.alias("place"))
        found = found.unionAll(met.select("doc_id", "e.keep_id", "e.group_size", "e.sha", "bucket", "place").select(*out))
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"), "bucket", F.col("place").alias("chain"))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs less the copies: of equal texts the row with the largest id stays, once. All columns are kept.

    Ids that repeat with different texts are told apart by the hash of the text.
    """
    found = stored(exact_dedup(docs, id_col, text_col).select("doc_id", "kept", "text_sha256"), "dedup-found")
    own, of_id, of_sha = (fresh(docs, c) for c in ("_own", "_id", "_sha"))
    gone = found.filter(~F.col("kept")).select(F.col("doc_id").alias(of_id), F.col("text_sha256").alias(of_sha))
    marked = docs.withColumn(own, F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    left = marked.join(gone, F.col(id_col).eqNullSafe(F.col(of_id)) & (F.col(own) == F.col(of_sha)), "left_anti")
    if not found.filter("kept").groupBy("doc_id", "text_sha256").count().filter("count > 1").isEmpty():
        left = left.dropDuplicates([id_col, own])
    return left.drop(own)
