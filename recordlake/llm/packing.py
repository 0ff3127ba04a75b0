"""Best-fit packing of documents into training sequences of several permitted lengths."""

from __future__ import annotations

import math
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, stored
from .token_counts import Tokenizer, count_tokens

CAPACITIES = (512, 1024, 2048, 4096, 8192)
#: Cost of a sequence besides its length, in tokens: what a shorter one must save.
BIN_COST = 16
#: Pieces that one task packs; more pieces make more shards.
SHARD_PIECES = 32768


def word_count(text: str | Column = "text") -> Column:
    """Words of a text and one end token, the default length; null counts as empty."""
    c = F.col(text) if isinstance(text, str) else text
    return (F.regexp_count(F.coalesce(c, F.lit("")), F.lit(f"[^{SPACE}]+")) + 1).cast("long")


def best_fit(lengths: np.ndarray, capacities: tuple[int, ...], bin_cost: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(bin of each item, offset in it, capacity of each bin); no item is longer than the last capacity.

    Items go longest first into the open bin that they leave least room in. Where none has room, a bin is opened: for
    each permitted capacity the items still to come, longest first, are laid into the rest of it, and the capacity
    with the least cost per token laid is taken. In the end each bin shrinks to the least capacity that holds it.
    """
    caps = sorted(capacities)
    order = np.argsort(-lengths, kind="stable")
    left = np.bincount(lengths, minlength=caps[-1] + 1)
    sizes = [int(x) for x in np.flatnonzero(left)]  # lengths still to come, ascending
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used: list[int] = []
    cap: list[int] = []
    rooms: list[int] = []  # distinct rooms of open bins, ascending
    at_room: dict[int, list[int]] = {}

    def laid(room: int) -> int:
        total, taken = 0, {}
        while room:
            k = bisect_left(sizes, room + 1) - 1
            while k >= 0 and left[sizes[k]] - taken.get(sizes[k], 0) <= 0:
                k -= 1
            if k < 0:
                break
            n = min(room // sizes[k], int(left[sizes[k]]) - taken.get(sizes[k], 0))
            taken[sizes[k]] = taken.get(sizes[k], 0) + n
            total, room = total + n * sizes[k], room - n * sizes[k]
        return total

    for i in order:
        n = int(lengths[i])
        left[n] -= 1
        if not left[n]:
            del sizes[bisect_left(sizes, n)]
        k = bisect_left(rooms, n)
        if k < len(rooms):
            room = rooms[k]
            b = at_room[room].pop()
            if not at_room[room]:
                del at_room[room], rooms[k]
        else:
            room = min((c for c in caps if c >= n), key=lambda c: ((c + bin_cost) / (n + laid(c - n)), c))
            b = len(used)
            used.append(0)
            cap.append(room)
        bins[i], offsets[i] = b, used[b]
        used[b] += n
        if room - n > 0:
            if room - n not in at_room:
                insort(rooms, room - n)
                at_room[room - n] = []
            at_room[room - n].append(b)
    return bins, offsets, [caps[bisect_left(caps, u)] for u in used]


def pack(docs: DataFrame, id_col: str = "doc_id", length: Column | None = None, capacities: tuple[int, ...] = CAPACITIES, bin_cost: int = BIN_COST, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """doc_id, piece, start, n_tokens, bin_id, bin_offset, bin_capacity, bin_used: where each piece of a document lies.

    length is an expression over docs, by default word_count("text"); a row of null or no length counts as 1 token. A
    document longer than the largest capacity is cut into pieces of that size and a rest. Pieces are dealt by hash to
    shards of about shard_pieces, which are packed apart from each other, so a source or group of any size spreads
    evenly. bin_id is shard.bin. Repeated ids and null ids are packed as rows of their own. Only what length
    reads is read of the other columns, whatever their names. No rows give no rows.
    """
    if not capacities or min(capacities) < 1:
        raise ValueError("capacities are positive")
    most = max(capacities)
    n = F.greatest(F.coalesce(word_count() if length is None else length, F.lit(1)), F.lit(1)).cast("long")
    sized = stored(docs.select(F.col(id_col).alias("doc_id"), n.alias("n")).withColumn("row", F.monotonically_increasing_id()), "pack-lengths")
    pieces = sized.select("doc_id", "row", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {most}"))).alias("piece"))
    pieces = pieces.select("doc_id", "row", "piece", (F.col("piece") * most).alias("start"), F.least(F.lit(most), F.col("n") - F.col("piece") * most).cast("int").alias("n_tokens"))
    total = sized.agg(F.sum(F.expr(f"(n - 1) div {most} + 1"))).first()[0] or 0
    shards = max(1, math.ceil(total / shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("row", "piece"), F.lit(shards)).cast("int"))

    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["row", "piece"], kind="stable").reset_index(drop=True)
        bins, offsets, caps = best_fit(pdf["n_tokens"].to_numpy(np.int64), capacities, bin_cost)
        filled = np.bincount(bins, weights=pdf["n_tokens"], minlength=len(caps)).astype(np.int64)
        return pd.DataFrame(
            {
                "doc_id": pdf["doc_id"], "piece": pdf["piece"], "start": pdf["start"], "n_tokens": pdf["n_tokens"],
                "bin_id": pdf["shard"].astype(str) + "." + pd.Series(bins).astype(str), "bin_offset": offsets, "bin_capacity": np.asarray(caps)[bins], "bin_used": filled[bins],
            }
        )

    kind = dict(sized.dtypes)["doc_id"]
    return dealt.groupBy("shard").applyInPandas(packed, f"doc_id {kind}, piece long, start long, n_tokens int, bin_id string, bin_offset long, bin_capacity int, bin_used long")


def pack_tokens(docs: DataFrame, tokenizer: Tokenizer | None = None, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """pack() by the tokens of a tokenizer, and an end for each document; null and empty texts are the end alone."""
    counted = count_tokens(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), tokenizer or Tokenizer())
    return pack(counted, length=F.col("n_tokens") + 1, **options)
