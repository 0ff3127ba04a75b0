"""Prefix trie of conversations: what conversations share from their first turns on, and what sharing it saves.

Conversations are rows of turn ids. Equal ones merge, the rest are dealt by range of their ids, and each task turns
blocks of its range into padded matrices, in which changes from row to row mark where nodes begin. What a block cannot
know alone, the nodes on the paths of its first and its last row, is put together afterwards.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .merkle import ranked

#: Bytes of a turn's id.
ID = 16
#: Cells of a padded matrix, at most about; a conversation that is longer is a block of its own.
CELLS = 1 << 21
#: Ids of conversations that are hashed as one piece.
PIECE = 512
#: Open nodes that are broadcast; more are joined by shuffle.
FEW_OPEN = 200_000
NOTHING = sha256(b"").hexdigest()

NODES = "open boolean, key binary, up_key binary, top binary, size long, conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
TOTALS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def numbered_turns(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id, i (place in the conversation from 0), n (turns of it), turn_id, size (UTF-8 bytes of the text) of each turn.

    Turns are in order of their number, null first, ties by their ids. The id is a hash of role and text, null as empty.
    Rows without a conversation's id belong to none and are left out.
    """
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 2 * ID))
    rows = conversations.filter(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), digest.alias("turn_id"), F.octet_length(text).cast("long").alias("size"))
    return ranked(stored(rows, "trie-turns"), "conv_id", ["turn", "turn_id"], "trie-numbered").drop("turn")


def sequences(parts: DataFrame) -> DataFrame:
    """conv_id, ids (one binary), sizes of each conversation that part 2 names: the turns of part 0, then those of part 1, by i."""
    turn = F.when(F.col("part") < 2, F.struct("part", "i", "turn_id", "size"))
    rows = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"), F.max("part").alias("last")).filter("last = 2")
    return rows.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda x: F.hex(x["turn_id"])), "")).alias("ids"), F.transform("t", lambda x: x["size"]).alias("sizes"))


def plain_sequences(turns: DataFrame) -> DataFrame:
    """sequences() of conversations as they are."""
    own = turns.select("conv_id", F.lit(1).alias("part"), "i", "turn_id", "size")
    return sequences(own.unionAll(_names(turns)))


def _names(turns: DataFrame) -> DataFrame:
    return turns.filter("i = 0").select("conv_id", F.lit(2).alias("part"), "i", "turn_id", "size")


def rebuilt_sequences(turns: DataFrame, family: int = 5, most: int = 9) -> DataFrame:
    """sequences() of conversations that begin as the first of their family: its first h turns, then their own after the first h.

    A family is conv_id - conv_id % family, h is crc32 of the id modulo most. So at most most - 1 turns of a conversation
    go to others, and no join is needed: they are sent to the ids that may be there, and those that are not go.
    """
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    first = F.col("conv_id") % family == 0
    own = turns.filter(first | (F.col("i") >= h)).select("conv_id", F.lit(1).alias("part"), "i", "turn_id", "size")
    ids = F.array(*[F.col("conv_id") + k for k in range(1 - family, family) if k])
    lent = turns.filter(first & (F.col("i") < most - 1)).select(F.col("conv_id").alias("_c"), F.explode(ids).alias("conv_id"), F.lit(0).alias("part"), "i", "turn_id", "size")
    lent = lent.filter((F.col("conv_id") - F.col("conv_id") % family == F.col("_c")) & (F.col("i") < h)).drop("_c")
    return sequences(own.unionAll(lent).unionAll(_names(turns)))


def ends_of(seqs: DataFrame) -> DataFrame:
    """of (hash of ids), ends_sha256: SHA-256 of the conversations' ids in ascending order, joined by commas.

    Ids are numbered within their sequence by ranges, joined in pieces where they are, and one task hashes the pieces of
    a sequence one after another, whatever their number, without holding them.
    """
    rows = ranked(seqs.select(F.unhex(F.sha2("ids", 256)).alias("of"), "conv_id"), "of", ["conv_id"], "trie-ends")
    piece = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    pieces = rows.groupBy("of", F.floor(F.col("i") / PIECE).alias("k")).agg(piece.alias("piece"))

    def hashed(batches):
        of, state = None, None
        for batch in batches:
            out = []
            for key, text in zip(batch.column("of").to_pylist(), batch.column("piece").to_pylist(), strict=True):
                if key != of:
                    if of is not None:
                        out.append((of, state.hexdigest()))
                    of, state = key, sha256()
                else:
                    state.update(b",")
                state.update(text.encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.string())], ["of", "ends_sha256"])
        if of is not None:
            yield pa.RecordBatch.from_arrays([pa.array([of], pa.binary()), pa.array([state.hexdigest()])], ["of", "ends_sha256"])

    return pieces.repartition("of").sortWithinPartitions("of", "k").select("of", "piece").mapInArrow(hashed, "of binary, ends_sha256 string")


def _codes(raw: np.ndarray) -> np.ndarray:
    """Numbers of ids, in the order of their bytes."""
    hi, lo = raw[:, 0], raw[:, 1]
    order = np.lexsort((lo, hi))
    new = np.ones(len(order), bool)
    new[1:] = (hi[order[1:]] != hi[order[:-1]]) | (lo[order[1:]] != lo[order[:-1]])
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


def _keys(ids: bytes) -> list[bytes]:
    """Names of the nodes on a path, from the root on: hashes of the ids up to each."""
    state, out = sha256(), []
    out.append(state.digest()[:ID])
    for k in range(0, len(ids), ID):
        state.update(ids[k : k + ID])
        out.append(state.copy().digest()[:ID])
    return out


def block_nodes(ids: list[bytes], sizes: np.ndarray, first: np.ndarray, copies: np.ndarray, ends: list[str]) -> dict[str, list | np.ndarray]:
    """Columns of NODES for a block of distinct sequences that are neighbours in the order of all.

    Nodes on the paths of the first and of the last row may go on in other blocks: they are open, and their own saving,
    their open children and whether they are leaves are left to joined(). Totals hold what is known of nodes below.
    """
    lens = np.array([len(x) // ID for x in ids], np.int64)
    rows, wide = len(ids), int(lens.max())
    codes = _codes(np.frombuffer(b"".join(ids), ">u8").reshape(-1, 2))
    turns, bytes_ = np.full((rows, wide + 1), -1, np.int64), np.zeros((rows, wide + 1), np.int64)
    inside = np.arange(wide + 1) < lens[:, None]
    turns[inside], bytes_[inside] = codes, sizes
    order = np.lexsort(turns.T[::-1])
    turns, bytes_, lens, first, copies = turns[order], bytes_[order], lens[order], first[order], copies[order]
    change = np.ones((rows, wide + 1), bool)
    change[1:] = turns[1:] != turns[:-1]
    np.logical_or.accumulate(change, axis=1, out=change)
    leaf = np.zeros(rows, np.int64)  # a row that the next one does not go on from
    if rows > 2:
        at = np.arange(1, rows - 1)
        leaf[at] = (lens[at] > 0) & change[at + 1, np.maximum(lens[at] - 1, 0)]
    paths = (_keys(ids[order[0]]), _keys(ids[order[-1]]))
    saved, begins = np.zeros(rows, np.int64), np.zeros(rows, np.int64)
    levels: list[dict] = []
    for depth in range(wide, -1, -1):
        valid = np.flatnonzero(lens >= depth)
        starts = np.flatnonzero(change[valid, depth - 1]) if depth else np.array([0])
        s = valid[starts]
        e = valid[np.append(starts[1:], len(valid)) - 1]
        total = lambda x, valid=valid, starts=starts: np.add.reduceat(x[valid], starts)
        n, open_ = total(copies), (s == 0) | (e == rows - 1)
        size = bytes_[s, depth - 1] if depth else np.zeros(1, np.int64)
        children = total(begins)
        own = s[~open_]
        saved[own] += ((n - 1) * size)[~open_]
        begins = np.zeros(rows, np.int64)
        begins[own] = 1
        levels.append({"s": s, "open": open_, "size": size, "conv_id": np.minimum.reduceat(first[valid], starts), "n_convs": n, "n_children": children, "n_leaves": total(leaf), "saved_tokens": total(saved)})
    levels.reverse()
    out: dict[str, list] = {c: [] for c in ("open", "key", "up_key", "top", "size", "conv_id", "depth", "parent_conv_id", *TOTALS, "ends_sha256")}
    for depth, x in enumerate(levels):
        key = [paths[0][depth] if a == 0 else paths[1][depth] if o else None for a, o in zip(x["s"].tolist(), x["open"].tolist(), strict=True)]
        if depth:
            up = levels[depth - 1]
            parent = np.searchsorted(up["s"], x["s"], side="right") - 1
            over = up["open"][parent]
            out["parent_conv_id"] += [None if o else c for o, c in zip(over.tolist(), up["conv_id"][parent].tolist(), strict=True)]
            out["up_key"] += [up["key"][k] if o else None for o, k in zip(over.tolist(), parent.tolist(), strict=True)]
            out["top"] += [None if k is None else paths[0][1] if a == 0 else paths[1][1] for k, a in zip(key, x["s"].tolist(), strict=True)]
        else:
            for c in ("parent_conv_id", "up_key", "top"):
                out[c].append(None)
        x["key"] = key
        out["key"] += key
        out["depth"] += [depth] * len(key)
        out["ends_sha256"] += [ends[order[a]] if lens[a] == depth else None for a in x["s"].tolist()]
        for c in ("open", "size", "conv_id", *TOTALS):
            out[c] += x[c].tolist()
    return out


def _blocks(batches, cells: int):
    """Neighbouring rows whose matrix has at most so many cells, or one row: (ids, sizes, first, copies, ends)."""
    for batch in batches:
        lens = pc.binary_length(batch.column("ids")).to_numpy(zero_copy_only=False) // ID + 1
        at = 0
        while at < len(lens):
            wide = np.maximum.accumulate(lens[at:])
            to = at + max(1, int(np.searchsorted(wide * np.arange(1, len(wide) + 1), cells, side="right")))
            part = batch.slice(at, to - at)
            sizes = part.column("sizes").flatten().to_numpy(zero_copy_only=False)
            yield part.column("ids").to_pylist(), sizes, part.column("first").to_numpy(), part.column("copies").to_numpy(), part.column("ends_sha256").to_pylist()
            at = to


def joined(key: tuple, table: pa.Table) -> pa.Table:
    """Open nodes below one first turn, each once, with what open nodes below give: they are children, leaves and savings.

    There are at most two paths of a block.
    """
    rows = table.to_pydict()
    at = {k: i for i, k in enumerate(rows["key"])}
    n = len(at)
    more_leaves, more_saved = [0] * n, [0] * n
    children = list(rows["n_children"])
    order = sorted(range(n), key=lambda i: -rows["depth"][i])
    for i in order:
        up = at.get(rows["up_key"][i])
        if children[i] == 0:
            more_leaves[i] += 1
        more_saved[i] += (rows["n_convs"][i] - 1) * rows["size"][i]
        if up is not None:
            children[up] += 1
            more_leaves[up] += more_leaves[i]
            more_saved[up] += more_saved[i]
    rows["n_children"] = children
    rows["n_leaves"] = [a + b for a, b in zip(rows["n_leaves"], more_leaves, strict=True)]
    rows["saved_tokens"] = [a + b for a, b in zip(rows["saved_tokens"], more_saved, strict=True)]
    return pa.table({**rows, "more_leaves": more_leaves, "more_saved": more_saved}, schema=pa.schema([*table.schema, ("more_leaves", pa.int64()), ("more_saved", pa.int64())]))


def prefix_trie(seqs: DataFrame, cells: int = CELLS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node.

    seqs: conv_id, ids, sizes. A node is a sequence of turns that a conversation begins with, the root the empty one;
    conv_id is the least of its conversations, n_leaves counts nodes without children below it or it itself, saved_tokens
    is what its subtree need not store again, and ends_sha256 hashes the conversations that end there. Copies are merged
    before they are dealt; a prefix that a third of all share lies over many blocks and is put together from their
    totals. A conversation is a row of 24 bytes a turn; long ones make small blocks. No conversations give no nodes.
    """
    seqs = stored(seqs, "trie-sequences")
    of = F.unhex(F.sha2("ids", 256)).alias("of")
    merged = seqs.groupBy("ids").agg(F.min("conv_id").alias("first"), F.count(F.lit(1)).alias("copies"), F.first("sizes").alias("sizes")).withColumn("of", of)
    merged = merged.join(ends_of(seqs), "of").select("ids", "sizes", "first", "copies", "ends_sha256")
    parts = max(1, int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = stored(merged, "trie-merged").repartitionByRange(parts, "ids").sortWithinPartitions("ids")

    def found(batches):
        for block in _blocks(batches, cells):
            yield pa.RecordBatch.from_pydict(block_nodes(*block), schema=_SCHEMA)

    nodes = stored(dealt.mapInArrow(found, NODES), "trie-nodes")
    least = [F.first(c, ignorenulls=True).alias(c) for c in ("up_key", "top")] + [F.min("conv_id").alias("conv_id"), F.max("size").alias("size"), F.max("ends_sha256").alias("ends_sha256")]
    open_ = stored(nodes.filter("open").groupBy("key", "depth").agg(*least, *[F.sum(c).alias(c) for c in TOTALS]), "trie-open")
    below = open_.filter("depth > 0")
    kind = ", ".join(f"{c} {k}" for c, k in below.dtypes) + ", more_leaves long, more_saved long"
    below = stored(below.groupBy("top").applyInArrow(joined, kind), "trie-joined")
    more = below.filter("depth = 1").agg(F.count(F.lit(1)).alias("c"), F.coalesce(F.sum("more_leaves"), F.lit(0)).alias("l"), F.coalesce(F.sum("more_saved"), F.lit(0)).alias("s")).first()
    alone = F.when(F.col("n_children") + more["c"] == 0, 1).otherwise(0)
    root = open_.filter("depth = 0").withColumns({"n_leaves": F.col("n_leaves") + more["l"] + alone, "saved_tokens": F.col("saved_tokens") + more["s"], "n_children": F.col("n_children") + more["c"]})
    ends = F.coalesce("ends_sha256", F.lit(NOTHING)).alias("ends_sha256")
    known = root.select(*open_.columns).unionByName(below.drop("more_leaves", "more_saved"))
    parents = known.select(F.col("key").alias("up_key"), F.col("conv_id").alias("up_conv_id"))
    sent = F.broadcast(parents) if parents.limit(FEW_OPEN + 1).count() <= FEW_OPEN else parents
    columns = ("conv_id", F.col("depth").cast("long").alias("depth"), F.coalesce("parent_conv_id", "up_conv_id").alias("parent_conv_id"), *TOTALS, ends)
    closed = nodes.filter("not open").join(sent, "up_key", "left").select(*columns)
    return closed.unionAll(known.withColumn("parent_conv_id", F.lit(None).cast("long")).join(sent, "up_key", "left").select(*columns))


_SCHEMA = pa.schema(
    [("open", pa.bool_()), *[(c, pa.binary()) for c in ("key", "up_key", "top")], ("size", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int32()), ("parent_conv_id", pa.int64()), *[(c, pa.int64()) for c in TOTALS], ("ends_sha256", pa.string())]
)


def conversation_trie(conversations: DataFrame, rebuilt: bool = False, cells: int = CELLS, **columns: str) -> DataFrame:
    """prefix_trie() of conversations, rebuilt or as they are.

    Null roles and texts are empty, null turns come first, turns of the same number by the hash of role and text; a row
    given again is a turn more. Rows without an id are left out. Other columns are not read, whatever their names. Very
    long texts are hashed where they lie. No rows give no nodes.
    """
    turns = numbered_turns(conversations, **columns)
    return prefix_trie(rebuilt_sequences(turns) if rebuilt else plain_sequences(turns), cells)
