"""Merkle manifest of a dataset: leaves by group and order, nodes of eight, kept as a log in the order in which nodes are complete.

A builder has a segment of leaves whose ends are multiples of its size, so that its subtree is whole: it appends each leaf,
and each node as soon as its run is complete. This is postorder; where a node stands follows from the numbers of nodes
that are complete before it, so that proofs address siblings by arithmetic and the log needs no pointers. Roots of
segments are the leaves of the next round of builders, and roots of groups are the leaves of a last tree.
"""

from __future__ import annotations

import functools
from binascii import hexlify
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import stored

#: Children of a node: 2 ** FAN_BITS.
FAN_BITS = 3
FAN = 1 << FAN_BITS
#: Levels that a builder adds above its leaves; its segment has FAN ** LEVELS of them.
LEVELS = 3
#: Rows of metadata that are broadcast; more are joined by shuffle.
FEW_ROWS = 100_000
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 64


def height(n: int) -> int:
    """Levels above n leaves until one node is left."""
    h = 0
    while (1 << FAN_BITS * h) < n:
        h += 1
    return h


@functools.lru_cache(maxsize=1024)
def positions(n: int, levels: int) -> tuple[np.ndarray, ...]:
    """By level, where the nodes over n leaves stand in the log.

    A node follows its last leaf e by its level, and before leaf e stand e leaves and e >> 3k complete nodes of level k.
    """
    out = []
    for level in range(levels + 1):
        width = FAN_BITS * level
        last = np.minimum((np.arange(-(-n >> width)) + 1) << width, n) - 1
        out.append(sum((last >> FAN_BITS * k for k in range(levels + 1)), np.zeros_like(last)) + level)
    return tuple(out)


def node(children: list[bytes]) -> bytes:
    return sha256(b"".join(children)).hexdigest().encode()


def built(leaves: list[bytes], levels: int) -> list[bytes]:
    """The log of a segment: leaves and nodes, as hex digits, in the order in which they are complete; the root is last."""
    log: list[bytes] = []
    waiting: list[list[bytes]] = [[] for _ in range(levels + 1)]
    for k, leaf in enumerate(leaves):
        log.append(leaf)
        waiting[0].append(leaf)
        level = 0
        while level < levels and (len(waiting[level]) == FAN or k == len(leaves) - 1):
            log.append(node(waiting[level]))
            waiting[level] = []
            level += 1
            waiting[level].append(log[-1])
    return log


def siblings(log: bytes, n: int, levels: int):
    """For each leaf of a segment, by level, the digests left and right of its own in its run, read from their positions."""
    at = positions(n, levels)
    rows = [b"".join([log[_HEX * p : _HEX * p + _HEX] for p in level.tolist()]) for level in at[:levels]]
    for leaf in range(n):
        lefts, rights = [], []
        for level, row in enumerate(rows):
            j = leaf >> FAN_BITS * level
            lo = j & -FAN
            lefts.append(row[_HEX * lo : _HEX * j])
            rights.append(row[_HEX * (j + 1) : _HEX * (lo + FAN)])
        yield lefts, rights


def folded(digest: bytes, lefts: list[bytes], rights: list[bytes]) -> bytes:
    """The root that a leaf and its siblings give."""
    for left, right in zip(lefts, rights, strict=True):
        digest = sha256(left + digest + right).hexdigest().encode()
    return digest


def leaf_text(columns: tuple[str, ...], replaced: dict[str, Column] | None = None) -> Column:
    """The columns as one text: - for null, else the number of UTF-8 bytes, a colon and the value."""
    parts = []
    for c in columns:
        v = (replaced or {}).get(c, F.col(f"`{c}`")).cast("string")
        parts.append(F.when(v.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(v).cast("string"), F.lit(":"), v)))
    return F.concat(*parts)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """rows with i, the place in their group from 0, and n, the rows of the group.

    Rows are sorted by ranges, equal ones dealt over them, so that no group and no key is one task's; what each range has
    of a group is counted, and the counts before it added to the places in the range.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order_ = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    at = rows.repartitionByRange(parts, *order_, F.rand(7)).sortWithinPartitions(*order_).withColumn("at", F.monotonically_increasing_id())
    at = stored(at.withColumn("part", F.shiftright("at", 33)), name)
    runs = at.groupBy("part", group).agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("k"))
    whole = Window.partitionBy(group)
    before = F.sum("k").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    runs = stored(runs.withColumns({"before": F.coalesce(before, F.lit(0)), "n": F.sum("k").over(whole)}).withColumnRenamed(group, "_g").withColumnRenamed("part", "_part"), f"{name}-runs")
    few = runs.limit(FEW_ROWS + 1).count() <= FEW_ROWS
    met = at.join(F.broadcast(runs) if few else runs, (F.col("part") == F.col("_part")) & F.col(group).eqNullSafe(F.col("_g")))
    return met.withColumn("i", F.col("at") - F.col("first") + F.col("before")).drop("at", "part", "_part", "_g", "first", "k", "before")


def _shape(n: int, segment: int, k: int, levels: int) -> tuple[int, int]:
    """(leaves, levels) of a segment of round k in a group of n leaves."""
    size = FAN**levels
    left = -(-n // size**k)
    return min(size, left - size * segment), levels if left > size else height(left)


def _siblings(r: dict, k: int, levels: int):
    """siblings() of a segment of round k."""
    return siblings(hexlify(r["log"]), *_shape(r["n"], r["segment"], k, levels))


def build(leaves: DataFrame, group: str, extra: tuple[str, ...] = (), levels: int = LEVELS) -> list[DataFrame]:
    """The log by rounds of builders, a row for each segment: group, segment, n, log, root, and in the first round the columns of extra as lists.

    leaves: group, i, n, digest and extra. A group whose nodes fit into one segment ends there.
    """
    kinds = dict(leaves.dtypes)
    rounds: list[DataFrame] = []
    most = leaves.agg(F.max("n")).first()[0] or 0
    cur, kept = leaves, extra

    def logged(batches, k, kept):
        for batch in batches:
            rows = batch.column("rows")
            logs, roots = [], []
            for n, segment, own in zip(batch.column("n").to_pylist(), batch.column("segment").to_pylist(), rows, strict=True):
                log = built([hexlify(x) for x in own.values.field("digest").to_pylist()], _shape(n, segment, k, levels)[1])
                logs.append(bytes.fromhex(b"".join(log).decode()))
                roots.append(bytes.fromhex(log[-1].decode()))
            lists = {c: pa.ListArray.from_arrays(_offsets(rows), rows.flatten().field(c)) for c in kept}
            yield pa.RecordBatch.from_pydict({group: batch.column(group), "segment": batch.column("segment"), "n": batch.column("n"), **lists, "log": pa.array(logs, pa.binary()), "root": pa.array(roots, pa.binary())})

    while True:
        rows = F.array_sort(F.collect_list(F.struct("i", "digest", *kept))).alias("rows")  # of a segment
        grouped = cur.groupBy(group, F.shiftright("i", FAN_BITS * levels).alias("segment")).agg(F.first("n").alias("n"), rows)
        schema = f"`{group}` {kinds[group]}, segment long, n long, " + "".join(f"`{c}` array<{kinds[c]}>, " for c in kept) + "log binary, root binary"
        rounds.append(stored(grouped.select(group, "segment", "n", "rows").mapInArrow(functools.partial(logged, k=len(rounds), kept=kept), schema), f"merkle-log{len(rounds)}"))
        done = FAN ** (levels * len(rounds))
        if most <= done:
            return rounds
        up = rounds[-1].filter(F.col("n") > done)
        cur, kept = up.select(group, F.col("segment").alias("i"), "n", F.col("root").alias("digest")), ()


def _offsets(lists: pa.ListArray) -> pa.Array:
    at = lists.offsets.to_numpy()
    return pa.array(at - at[0], pa.int32())


def group_roots(rounds: list[DataFrame], group: str, levels: int = LEVELS) -> DataFrame:
    """group, root: of each group, from the round in which it ended."""
    ended = [r.filter(F.col("n") <= FAN ** (levels * (k + 1))).select(group, "root") for k, r in enumerate(rounds)]
    return functools.reduce(DataFrame.unionAll, ended)


def paths(rounds: list[DataFrame], group: str, above: DataFrame, carried: tuple[str, ...] = (), levels: int = LEVELS) -> DataFrame:
    """The first round's segments with lefts and rights, the siblings of each segment's root on the way to the top.

    above: group, lefts, rights of each group's root, and the columns of carried, which go down with them.
    """
    kinds = dict(above.dtypes)
    down: DataFrame | None = None
    for k in reversed(range(len(rounds))):
        ended = rounds[k].filter(F.col("n") <= FAN ** (levels * (k + 1))).select(F.col(group).alias("_h")).join(above, F.col("_h").eqNullSafe(F.col(group))).drop("_h")
        known = ended.withColumn("segment", F.lit(0).cast("long"))
        known = known if down is None else known.unionByName(down)
        known = known.withColumnsRenamed({group: "_g", "segment": "_s"})
        met = rounds[k].join(known, F.col(group).eqNullSafe(F.col("_g")) & (F.col("segment") == F.col("_s"))).drop("_g", "_s")
        if k == 0:
            return met

        def children(batches, k=k):
            for batch in batches:
                out: dict[str, list] = {c: [] for c in (group, "segment", "lefts", "rights", *carried)}
                for r in _rows([batch]):
                    for j, (lefts, rights) in enumerate(_siblings(r, k, levels)):
                        for c, v in ((group, r[group]), ("segment", (r["segment"] << FAN_BITS * levels) + j), ("lefts", lefts + r["lefts"]), ("rights", rights + r["rights"]), *((c, r[c]) for c in carried)):
                            out[c].append(v)
                yield pa.RecordBatch.from_pydict({c: pa.array(v, batch.schema.field(c).type) for c, v in out.items()})

        schema = f"`{group}` {kinds[group]}, segment long, lefts array<binary>, rights array<binary>" + "".join(f", {c} {kinds[c]}" for c in carried)
        down = stored(met.select(group, "segment", "n", "log", "lefts", "rights", *carried).mapInArrow(children, schema), f"merkle-paths{k}")
    raise AssertionError("no rounds")


def _rows(batches):
    """Rows as dicts, one at a time, since a row is a segment."""
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


class Manifest:
    """The log of a dataset, as segments in the shared folder, and the roots over them.

    Leaves ascend by id in their group, null ids first, rows with the same id by their digests; groups ascend by name,
    null first. Equal rows are a leaf each. Only the columns that are named are read.
    """

    def __init__(self, docs: DataFrame, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", group_col: str = "lang", tampered: dict[str, Column] | None = None, where: Column | None = None, levels: int = LEVELS):
        self.levels = levels
        self.kind, self.group_kind = dict(docs.dtypes)[id_col], dict(docs.dtypes)[group_col]
        digest = lambda x: F.unhex(F.sha2(leaf_text(columns, x), 256))
        wrong = F.when(where, digest(tampered)) if tampered else F.lit(None).cast("binary")
        rows = stored(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{group_col}`").alias("g"), digest(None).alias("digest"), wrong.alias("tampered")), "merkle-leaves")
        self.rounds = build(ranked(rows, "g", ["id", "digest"], "merkle-ranked"), "g", ("id", "tampered"), levels)
        roots = group_roots(self.rounds, "g", levels).select(F.lit(0).alias("all"), F.col("g").alias("name"), F.col("root").alias("digest"), F.col("root").alias("subroot"))
        self.top = build(ranked(roots, "all", ["name"], "merkle-groups"), "all", ("name", "subroot"), levels)

    def root(self) -> str | None:
        """The root over all groups; None without rows."""
        found = group_roots(self.top, "all", self.levels).first()
        return found["root"].hex() if found else None

    def proofs(self, with_siblings: bool = True) -> DataFrame:
        """id, group, leaf, tampered (the leaf given instead of it, or null), subroot, root, lefts, rights, proof_sha256, folded_root, verified of each row.

        lefts and rights: the siblings before and after the digest by level, up to the root, as hex digits, or null if they are
        not asked for. folded_root is what the tampered leaf, else the leaf, gives with them.
        """
        above, levels = self.root(), self.levels
        none = F.array().cast("array<binary>")
        tops = paths(self.top, "all", self.rounds[0].sparkSession.range(1).select(F.col("id").cast("int").alias("all"), none.alias("lefts"), none.alias("rights")), (), levels)

        def groups(batches):
            for batch in batches:
                rows = []
                for r in _rows([batch]):
                    for (lefts, rights), name, subroot in zip(_siblings(r, 0, levels), r["name"], r["subroot"], strict=True):
                        rows.append((name, lefts + r["lefts"], rights + r["rights"], subroot.hex()))
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((batch.schema.field("name").type.value_type, pa.list_(pa.binary()), pa.list_(pa.binary()), pa.string()))], ["g", "lefts", "rights", "subroot"])

        of_group = stored(tops.mapInArrow(groups, f"g {self.group_kind}, lefts array<binary>, rights array<binary>, subroot string"), "merkle-subroots")
        rows = paths(self.rounds, "g", of_group, ("subroot",), levels)

        def proven(batches):
            for r in _rows(batches):
                log, tail, n = hexlify(r["log"]), b"".join(x + y for x, y in zip(r["lefts"], r["rights"], strict=True)), len(r["id"])
                leaves = [log[_HEX * p : _HEX * p + _HEX] for p in positions(n, _shape(r["n"], r["segment"], 0, levels)[1])[0].tolist()]
                proofs, ends, all_lefts, all_rights = [], [], [], []
                for leaf, wrong, (lefts, rights) in zip(leaves, r["tampered"], _siblings(r, 0, levels), strict=True):
                    proof = sha256(b"".join(x + y for x, y in zip(lefts, rights, strict=True)))
                    proof.update(tail)
                    proofs.append(proof.hexdigest())
                    lefts, rights = lefts + r["lefts"], rights + r["rights"]
                    ends.append(folded(leaf if wrong is None else hexlify(wrong), lefts, rights).decode())
                    all_lefts.append(lefts if with_siblings else None)
                    all_rights.append(rights if with_siblings else None)
                digests = pa.list_(pa.binary())
                out = {
                    "id": r["id"], "g": [r["g"]] * n, "leaf": [x.decode() for x in leaves], "tampered": [x and x.hex() for x in r["tampered"]], "subroot": [r["subroot"]] * n, "root": [above] * n,
                    "lefts": pa.array(all_lefts, digests), "rights": pa.array(all_rights, digests), "proof_sha256": proofs, "folded_root": ends, "verified": [x == above for x in ends],
                }
                yield pa.RecordBatch.from_pydict({c: v if isinstance(v, pa.Array) else pa.array(v, kinds.get(c, pa.string())) for c, v in out.items()})

        kinds = {"id": to_arrow_type(rows.schema["id"].dataType.elementType), "g": to_arrow_type(rows.schema["g"].dataType), "verified": pa.bool_()}
        schema = f"id {self.kind}, g {self.group_kind}, leaf string, tampered string, subroot string, root string, lefts array<binary>, rights array<binary>, proof_sha256 string, folded_root string, verified boolean"
        return rows.mapInArrow(proven, schema).withColumnRenamed("g", "group")

    def log(self) -> DataFrame:
        """group, position, level, digest: the log of each group, positions from 0."""

        levels, kind = self.levels, to_arrow_type(self.rounds[0].schema["g"].dataType)

        def listed(batches, k):
            for r in _rows(batches):
                rows = []
                for level, local in enumerate(positions(*_shape(r["n"], r["segment"], k, levels))):
                    whole = level + levels * k
                    for j, p in enumerate(local.tolist() if level or not k else []):  # the leaves of later rounds stand there already
                        j += r["segment"] << FAN_BITS * (levels - level)
                        last = min((j + 1) << FAN_BITS * whole, r["n"]) - 1
                        rows.append((sum(last >> FAN_BITS * x for x in range(height(r["n"]) + 1)) + whole, whole, r["log"][32 * p : 32 * p + 32].hex()))
                yield pa.RecordBatch.from_arrays([pa.array([r["g"]] * len(rows), kind), *[pa.array([x[c] for x in rows], t) for c, t in enumerate((pa.int64(), pa.int32(), pa.string()))]], ["g", "position", "level", "digest"])

        schema = f"g {self.group_kind}, position long, level int, digest string"
        parts = [r.select("g", "segment", "n", "log").mapInArrow(functools.partial(listed, k=k), schema) for k, r in enumerate(self.rounds)]
        return functools.reduce(DataFrame.unionAll, parts).withColumnRenamed("g", "group")


def manifest_proofs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_col: str = "lang", columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of each row.

    A third of the rows, by crc32 of the id, is tampered with: A to Z of the text become a to z. A row is verified if
    what is left of it still leads to the root, as rows without capitals do. Null columns are - in a leaf; rows of null
    ids are not tampered with; a null group is a group. Very long texts are hashed whole; other columns are not read. No
    rows give no rows.
    """
    where = F.crc32(F.col(f"`{id_col}`").cast("string").cast("binary")) % 3 == 0
    m = Manifest(docs, columns, id_col, group_col, {text_col: lower_ascii(F.col(f"`{text_col}`"))}, where)
    return m.proofs(False).select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
