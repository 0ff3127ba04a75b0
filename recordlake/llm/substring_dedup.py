"""Repeated passages: FM-indexes of shards of the corpus, searched backward by the documents that share something with a shard."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, discard, mix, released, rolling, slices, stored
from .fm_index import FmIndex, repeated_windows

WINDOW = 35
#: Words of the pieces whose hashes deal windows to shards.
PIECE = 8
#: Words that one index holds, about.
SHARD_WORDS = 1_000_000
#: Words of different segments under one key beyond which its windows are dealt by their own hashes.
HOT_WORDS = 1 << 18
_U = np.uint64
_PLACE = 26


def segments(h: np.ndarray, row: np.ndarray, window: int, piece: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, key) of the runs of windows that share their least piece hash: equal windows have equal keys.

    The least piece of a window depends on its words alone, so windows that are equal go to the same key wherever
    they stand, and a run of windows with the same least piece travels as one segment of at most 2 * window words.
    """
    n = len(h) - window + 1
    if n <= 0:
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.int64),)
    v = rolling(h, piece)
    place = np.arange(len(v), dtype=np.uint64)
    low = ((v >> _U(_PLACE)) << _U(_PLACE)) | place if len(v) < 1 << _PLACE else None
    span = window - piece + 1
    if low is None:  # more words than a place has bits: in parts that overlap by a window
        half = 1 << (_PLACE - 1)
        parts = [(i, segments(h[i : i + half + window - 1], row[i : i + half + window - 1], window, piece)) for i in range(0, n, half)]
        return tuple(np.concatenate([p[k] + (i if k == 0 else 0) for i, p in parts]) for k in range(3))
    least, width = low, 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    at = (least[:n] & _U((1 << _PLACE) - 1)).astype(np.int64)
    ok = row[:n] == row[window - 1 :]
    new = np.ones(n, bool)
    new[1:] = (at[1:] != at[:-1]) | ~ok[:-1]
    first = np.flatnonzero(new & ok)
    if not len(first):
        return (np.empty(0, np.int64),) * 2 + (np.empty(0, np.int64),)
    run = np.cumsum(new & ok) - 1
    windows = np.bincount(run[ok], minlength=len(first))
    return first, windows + window - 1, v[at[first]].view(np.int64)


def _content(h: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hash of the words of each segment."""
    with np.errstate(over="ignore"):
        at = np.repeat(first - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum())
        inside = at - np.repeat(first, length)
        x = mix(h[at] + inside.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        starts = np.concatenate([[0], np.cumsum(length)[:-1]])
        return mix(np.add.reduceat(x, starts) + length.astype(np.uint64)).view(np.int64) if len(first) else np.empty(0, np.int64)


def search_shard(rows: pa.Table, window: int) -> pa.Table:
    """(key, content, first, last): runs of windows of the shard's segments that occur more than once, as places in them.

    Each segment is in the index once, with the number of its copies as weight, and streams through it backward.
    """
    w = Words(rows["text"].combine_chunks())
    codes, bounds = w.codes.astype(np.int64) + 1, w.bounds
    index = FmIndex(codes, bounds, sigma=len(w.vocab) + 1, weights=rows["copies"].to_numpy())
    hit = repeated_windows(index, codes, bounds, window, 2)
    edge = np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))
    s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    seg = np.searchsorted(bounds, s, side="right") - 1
    who = pa.array(seg)
    return pa.table({"key": rows["key"].take(who), "content": rows["content"].take(who), "first": pa.array((s - bounds[seg]).astype(np.int32)), "last": pa.array((e - bounds[seg]).astype(np.int32))})


def _quoted(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted (key, content, copies, id, th, start, length) with the words of the text there, one row for each (key, content)."""
    kind = dict(texts.dtypes)["id"]
    who = F.struct("id", "th").cast(f"struct<id:{kind},th:bigint>")  # equal with null ids too; of one type on both sides, else the join shuffles texts again
    lists = wanted.withColumn("who", who).groupBy("who").agg(F.collect_list(F.struct("start", "length", "key", "content", "copies")).alias("s"))
    once = texts.select(who.alias("who"), "text").groupBy("who").agg(F.first("text").alias("text"))  # rows given again merge before the shuffle, so nothing is quoted twice
    taken = once.join(lists, "who").select("who.id", "who.th", "text", "s")

    def quoted(batches):
        for batch in batches:
            for at, part in slices(batch.column(2)):
                w = Words(part)
                own = batch.column(3).slice(at, len(part))
                row = pc.list_parent_indices(own).to_numpy()
                s = own.flatten()
                start, length = (s.field(c).to_numpy() for c in ("start", "length"))
                begin = w.bounds[row] + start
                take = np.repeat(begin - np.concatenate([[0], np.cumsum(length)[:-1]]), length) + np.arange(length.sum()) if len(row) else np.empty(0, np.int64)
                words = w.vocab.take(pa.array(w.codes[take]))
                text = pc.binary_join(pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(length)]).astype(np.int32), words), " ")
                ids = (batch.column(c).slice(at, len(part)).take(pa.array(row)) for c in (0, 1))
                yield pa.RecordBatch.from_arrays([s.field("key"), s.field("content"), s.field("copies"), *ids, s.field("start"), text], ["key", "content", "copies", "id", "th", "start", "text"])

    return taken.mapInArrow(quoted, f"key long, content long, copies long, id {kind}, th long, start int, text string")


def _windows(quotes: DataFrame, window: int) -> DataFrame:
    """The windows of segments: (key, content) are two hashes of a window, (of_key, of_content, offset) where it is, and a place in a text."""
    kind = dict(quotes.dtypes)["id"]

    def cut(batches):
        for batch in batches:
            for at, part in slices(batch.column(6)):
                w = Words(part)
                h = w.hashes()[w.codes]
                row, one = w.rows(), rolling(h, window)
                two = rolling(mix(h), window)
                at_ = np.flatnonzero(row[: len(one)] == row[window - 1 :]) if len(one) else np.empty(0, np.int64)
                own = pa.array(row[at_])
                offset = (at_ - w.bounds[row[at_]]).astype(np.int32)
                key, content, copies, id_, th, start = (batch.column(k).slice(at, len(part)).take(own) for k in range(6))
                yield pa.RecordBatch.from_arrays([pa.array(one[at_].view(np.int64)), pa.array(two[at_].view(np.int64)), key, content, pa.array(offset), copies, id_, th, pc.add(start, pa.array(offset))], ["key", "content", "of_key", "of_content", "offset", "copies", "id", "th", "start"])

    return quotes.select("key", "content", "copies", "id", "th", "start", "text").mapInArrow(cut, f"key long, content long, of_key long, of_content long, offset int, copies long, id {kind}, th long, start int")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, piece: int = PIECE, shard_words: int = SHARD_WORDS, hot_words: int = HOT_WORDS) -> DataFrame:
    """doc_id, text_hash, spans: for each document with repeated windows the runs of words that they cover.

    1. Every window of each text goes to the key of its least piece. Keys that occur once are done with.
    2. Segments of the same key and words are merged, with the number of their copies.
    3. Shards of keys are indexed (FmIndex), every different segment once and weighted by its copies. Each segment
       streams through the index of its shard by backward search, which yields the windows of it that occur again.
    4. Runs of repeated windows return to all places of their segments.
    Hashes only say which windows meet in an index. A key whose segments have more than hot_words, such as a passage
    within many different texts, would fill an index alone: the windows of its segments are dealt by their own hashes
    instead, those that occur once are done with, and the others are indexed and searched as segments of one window.
    """
    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("th"), F.col(text_col).alias("text"))

    def cut(part: pa.Array):
        w = Words(part)
        h = w.hashes()[w.codes] if len(w.codes) else np.empty(0, np.uint64)
        row = w.rows()
        first, length, key = segments(h, row, window, piece)
        return w, first, length, key, row[first] if len(first) else first, _content(h, first, length)

    def placed(batches):
        for batch in batches:
            for at, part in slices(batch.column(2)):
                w, first, length, key, row, content = cut(part)
                r = pa.array(row + at)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(r), batch.column(1).take(r), pa.array((first - w.bounds[row]).astype(np.int32)), pa.array(length.astype(np.int32)), pa.array(key), pa.array(content)], ["id", "th", "start", "length", "key", "content"])

    with released(docs.sparkSession):
        places = stored(texts.mapInArrow(placed, f"id {kind}, th long, start int, length int, key long, content long"), "fm-places")
        shared = stored(places.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("key"), "fm-keys")
        met = stored(places.join(shared, "key", "left_semi"), "fm-met")  # of two tables, so that a hot key can be split
        for old in (places, shared):
            discard(old)
        kinds = met.groupBy("key", "content", "length").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("id", "th", "start")).alias("at"))
        kinds = stored(kinds.select("key", "content", "length", "copies", "at.*"), "fm-kinds")
        by_key = kinds.groupBy("key").agg(F.sum("length").alias("words"))
        hot = stored(by_key.filter(F.col("words") > hot_words).select("key"), "fm-hot")
        plain, dealt = kinds, None

        def search(quotes: DataFrame, words: int) -> DataFrame:
            shards = F.pmod(F.xxhash64("key"), F.lit(max(1, math.ceil(words / shard_words))))
            return quotes.select(shards.alias("shard"), "key", "content", "copies", "text").groupBy("shard").applyInArrow(lambda t: search_shard(t, window), "key long, content long, first int, last int")

        if not hot.isEmpty():
            plain = kinds.join(hot, "key", "left_anti")
            windows = stored(_windows(_quoted(texts, kinds.join(hot, "key", "left_semi")), window), "fm-windows")
            again = windows.groupBy("key", "content").agg(F.sum("copies").alias("copies"), F.min(F.struct("id", "th", "start")).alias("at")).filter("copies > 1")
            again = stored(again.select("key", "content", F.lit(window).alias("length"), "copies", "at.*"), "fm-again")
            own = stored(search(_quoted(texts, again), again.count() * window).select("key", "content"), "fm-own")
            dealt = own.join(windows, ["key", "content"]).select(F.col("of_key").alias("key"), F.col("of_content").alias("content"), F.col("offset").alias("first"), F.col("offset").alias("last"))
            dealt = stored(dealt, "fm-dealt")
            for old in (windows, again, own):
                discard(old)
        spans = stored(search(_quoted(texts, plain), plain.agg(F.sum("length")).first()[0] or 0), "fm-spans")
        for old in (kinds, hot):
            discard(old)
    spans = spans if dealt is None else spans.unionAll(dealt)
    back = met.join(spans, ["key", "content"]).select("id", "th", (F.col("start") + F.col("first")).alias("from"), (F.col("start") + F.col("last") + window).alias("to")).distinct()
    spans_of = back.groupBy("id", "th").agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    return spans_of.withColumnsRenamed({"id": "doc_id", "th": "text_hash"})


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text, kept_sha256, spans of each row: words in a repeated window are removed.

    A window is repeated if its word sequence also starts anywhere else, in the same text too; windows are judged on
    the input. Kept words are joined by one space. A null text has no words; repeated rows repeat each other; a null id
    is an id like others. spans holds [from, to) in words, ascending and apart, empty where nothing goes. Very long texts
    are cut into segments like others; other columns are not read, whatever their names. No rows give no rows.
    """
    kind = dict(docs.dtypes)[id_col]
    found = repeated_passages(docs, id_col, text_col, window).withColumnsRenamed({"doc_id": "_id", "text_hash": "_th"})
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(text_col, F.lit(""))).alias("th"), F.col(text_col).alias("text"))
    rows = rows.join(found, F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left").select("id", "text", "spans")

    def kept(batches):
        for batch in batches:
            for at, part in slices(batch.column(1)):
                w = Words(part)
                lists = batch.column(2).slice(at, len(part))
                row = pc.list_parent_indices(lists).to_numpy()
                s = lists.flatten()
                base = w.bounds[row]
                edge = np.zeros(len(w.codes) + 1, np.int64)
                np.add.at(edge, base + s.field("from").to_numpy(), 1)
                np.add.at(edge, base + s.field("to").to_numpy(), -1)
                gone = np.cumsum(edge[:-1]) > 0
                text_row = w.rows()
                removed = np.bincount(text_row[gone], minlength=len(part))
                stay = ~gone
                left = np.concatenate([[0], np.cumsum(w.counts - removed)]).astype(np.int32)
                texts = pc.binary_join(pa.ListArray.from_arrays(left, w.vocab.take(pa.array(w.codes[stay]))), " ")
                sha = [hashlib.sha256(t.as_buffer()).hexdigest() for t in texts]
                change = np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))
                begins, ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
                starts_doc = w.bounds[1:-1]
                cuts = starts_doc[(starts_doc > 0) & (starts_doc < len(gone))]
                cuts = cuts[gone[cuts] & gone[cuts - 1]] if len(cuts) else cuts  # a run does not pass from text to text
                begins, ends = np.sort(np.concatenate([begins, cuts])), np.sort(np.concatenate([ends, cuts]))
                own = text_row[begins]
                spans = pa.StructArray.from_arrays([pa.array((begins - w.bounds[own]).astype(np.int32)), pa.array((ends - w.bounds[own]).astype(np.int32))], ["from", "to"])
                spans = pa.ListArray.from_arrays(np.searchsorted(own, np.arange(len(part) + 1)).astype(np.int32), spans)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), pa.array(w.counts), pa.array(removed.astype(np.int64)), texts, pa.array(sha), spans], ["doc_id", "n_words", "n_removed", "kept_text", "kept_sha256", "spans"])

    return rows.mapInArrow(kept, f"doc_id {kind}, n_words long, n_removed long, kept_text string, kept_sha256 string, spans array<struct<from:int,to:int>>")
