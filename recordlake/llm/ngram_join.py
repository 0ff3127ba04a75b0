"""Jaccard self-join of documents on word n-grams: a MinHash LSH forest proposes, exact sets decide."""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, as_binary, discard, fresh, mix, one_thread, rolling, slices, stored
from .graph import components

_U = np.uint64


#: Bits of a MinHash value in a label; five values make a long.
BITS = 12


@dataclass(frozen=True)
class Forest:
    """trees: prefix tries of the forest; longest and shortest: values of a matched prefix, which is shortened step values at a time; recall: share of the links
    that is to be found; near: labels before each in the order of a tree that it is compared with; doubt: standard
    errors that the similarity of two sketches may be below the threshold; block: documents of a cluster that are
    compared with each other at once."""

    words: int = 5
    threshold: float = 0.8
    trees: int = 32
    longest: int = 10
    shortest: int = 4
    step: int = 2
    recall: float = 0.995
    near: int = 3
    doubt: float = 5.0
    block: int = 256
    seed: int = 11

    def chance(self, similarity: float | np.ndarray, depth: int) -> float | np.ndarray:
        """Chance that two sets share a prefix of depth values in some tree."""
        return 1 - (1 - similarity**depth) ** self.trees

    def least(self) -> float:
        """Similarity of sketches from which on two sets are linked for the exact comparison."""
        n = self.trees * self.sketched()
        return self.threshold - self.doubt * (self.threshold * (1 - self.threshold) / n) ** 0.5

    def sketched(self) -> int:
        """Values of each tree that make the sketch, a byte each."""
        return min(self.longest, 4)


def shingles(w: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds): the set of runs of n words of each text, ascending; a text of fewer words is one run of them all."""
    h = w.hashes()[w.codes] if len(w.codes) else np.empty(0, np.uint64)
    row, counts = w.rows(), w.counts
    s = rolling(h, n)
    ok = row[: len(s)] == row[n - 1 :] if len(s) else np.empty(0, bool)
    s, r = s[ok], row[: len(ok)][ok]
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        more = np.array([int(mix(rolling(h[w.bounds[i] : w.bounds[i + 1]], int(counts[i])) + _U(counts[i]))[0]) for i in short], np.uint64)
        s, r = np.concatenate([s, more]), np.concatenate([r, short])
    order = np.lexsort((s, r))
    s, r = s[order], r[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (r[1:] != r[:-1])
    s, r = s[new], r[new]
    return s, np.searchsorted(r, np.arange(len(counts) + 1))


def _identity(s: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that stand for each set; 0 for an empty one."""
    full = np.flatnonzero(np.diff(bounds))
    out = np.zeros((2, len(bounds) - 1), np.uint64)
    if len(full):
        with np.errstate(over="ignore"):
            out[0, full] = np.add.reduceat(s, bounds[full])
            out[1, full] = np.add.reduceat(mix(s ^ _U(0xA5A5A5A5A5A5A5A5)), bounds[full])
    return out[0].view(np.int64), out[1].view(np.int64)


def _signatures(s: np.ndarray, bounds: np.ndarray, p: Forest) -> tuple[np.ndarray, np.ndarray]:
    """(labels, sketches): for each set and tree two longs that hold the label's values, first ones highest; a byte of some values."""
    rng = np.random.default_rng(p.seed)
    a = (rng.integers(0, 1 << 31, p.trees * p.longest, dtype=np.uint64) * _U(2) + _U(1)).astype(np.uint32)
    b = rng.integers(0, 1 << 32, p.trees * p.longest, dtype=np.uint64).astype(np.uint32)
    full = np.flatnonzero(np.diff(bounds))
    x, starts = (s >> _U(32)).astype(np.uint32), bounds[full]
    labels = np.zeros((len(bounds) - 1, p.trees, 2), np.int64)
    sketches = np.zeros((len(bounds) - 1, p.trees, p.sketched()), np.uint8)
    with np.errstate(over="ignore"):
        for t in range(p.trees):
            for d in range(p.longest):
                k = t * p.longest + d
                v = np.minimum.reduceat(x * a[k] + b[k], starts) if len(full) else np.empty(0, np.uint32)
                labels[full, t, d // 5] |= (v & np.uint32((1 << BITS) - 1)).astype(np.int64) << (BITS * (4 - d % 5))
                if d < p.sketched():
                    sketches[full, t, d] = (v >> np.uint32(4)).astype(np.uint8)
    return labels, sketches.reshape(len(sketches), -1)


def common_prefix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Values that labels (rows of two longs) begin with in common."""
    out, same = np.zeros(len(a), np.int64), np.ones(len(a), bool)
    for d in range(10):
        at = BITS * (4 - d % 5)
        same &= (a[:, d // 5] >> at) == (b[:, d // 5] >> at)
        out += same
    return out


def _neighbours(labels: DataFrame, p: Forest) -> DataFrame:
    """(a, b, depth): sets whose labels are next to each other in the order of some tree, by the longest prefix they share.

    labels: (tree, hi, lo, rep). The order is that of all labels, dealt to tasks by range, so that a prefix of any
    number of sets spreads over tasks; a task's first labels do not meet the last ones of the task before.
    """

    def met(batches):
        last = np.empty((0, 4), np.int64)
        for batch in batches:
            rows = np.concatenate([last, np.stack([batch.column(k).to_numpy() for k in range(4)], 1)])
            for gap in range(1, p.near + 1):
                to = np.arange(max(gap, len(last)), len(rows))
                at = to - gap
                ok = rows[to, 0] == rows[at, 0]
                to, at = to[ok], at[ok]
                depth = np.minimum(common_prefix(rows[to, 1:3], rows[at, 1:3]), p.longest)
                some = (depth >= p.shortest) & (rows[to, 3] != rows[at, 3])
                pair = np.sort(np.stack([rows[to, 3], rows[at, 3]], 1)[some], 1)
                yield pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1]), pa.array(depth[some].astype(np.int32))], ["a", "b", "depth"])
            last = rows[-p.near :]

    order = ["tree", "hi", "lo", "rep"]
    found = labels.select(*[F.col(c).cast("long") for c in order]).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(met, "a long, b long, depth int")
    return found.groupBy("a", "b").agg(F.max("depth").alias("depth"))


def _alike(x: pa.Array, y: pa.Array) -> np.ndarray:
    """Similarity that two columns of sketches say."""
    if not len(x):
        return np.empty(0)
    x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(len(c), -1) for c in (x, y))
    return np.clip(((x == y).mean(1) - 1 / 256) / (1 - 1 / 256), 0, 1)


def _linked(pairs: DataFrame, sketches: DataFrame, p: Forest) -> tuple[DataFrame | None, int]:
    """(pairs (a, b) whose sketches are like enough, the depth that was come to).

    Prefixes are shortened step by step. Two things must say that enough is found: the pairs that the last step
    brought are at most 1 - recall of all (what is below the depth, seen by looking there), and those found at this
    depth, each weighted by its chance to be found, leave at most 1 - recall missing.
    """
    total, out, found = 0, None, np.zeros(1001)

    def judged(batches):
        for batch in batches:
            s = _alike(batch.column(3), batch.column(4))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(s)], ["a", "b", "depth", "s"]).filter(pa.array(s >= p.least()))

    of = lambda c: sketches.select(F.col("rep").alias(c), F.col("sketch").alias(f"{c}_sketch"))
    for depth in range(p.longest, p.shortest - 1, -p.step):
        new = pairs.filter(F.col("depth").between(depth, depth + p.step - 1)).join(of("a"), "a").join(of("b"), "b").select("a", "b", "depth", "a_sketch", "b_sketch")
        new = stored(new.mapInArrow(judged, "a long, b long, depth int, s double"), "join-linked")
        out = new if out is None else out.unionAll(new)
        for r in new.groupBy(F.round(F.col("s") * 1000).cast("int").alias("s")).count().collect():  # at most 1001
            found[r["s"]] += r["count"]
        expected = (found / p.chance(np.maximum(np.arange(1001) / 1000, p.threshold), depth)).sum()
        if total and found.sum() - total <= (1 - p.recall) * found.sum() and found.sum() >= p.recall * expected:
            break
        total = found.sum()
    return out, depth


def compare(sets: list[np.ndarray], sides: np.ndarray, same: bool, threshold: Fraction, columns: int = 4096) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, similarity) of the pairs that reach the threshold: all pairs if same, else pairs of different sides."""
    sizes = np.array([len(x) for x in sets])
    values, col = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = np.bincount(col, minlength=len(values)) > 1
    rank = np.cumsum(shared) - 1
    keep = shared[col]
    owner, col = owner[keep], rank[col[keep]]
    order = np.argsort(col, kind="stable")
    owner, col = owner[order], col[order]
    both = np.zeros((len(sets), len(sets)), np.float32)
    total = int(col[-1]) + 1 if len(col) else 0
    for c in range(0, total, columns):
        lo, hi = np.searchsorted(col, [c, c + columns])
        m = np.zeros((len(sets), min(columns, total - c)), np.float32)
        m[owner[lo:hi], col[lo:hi] - c] = 1
        both += m @ m.T
    both = np.rint(both).astype(np.int64)
    either = sizes[:, None] + sizes[None, :] - both
    ok = (both * threshold.denominator >= threshold.numerator * either) & np.triu(np.ones(both.shape, bool), 1)
    if not same:
        ok &= sides[:, None] != sides[None, :]
    i, j = np.nonzero(ok)
    return i, j, both[i, j] / either[i, j]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Least member of each one's component."""
    root = np.arange(n)
    while True:
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            return root
        root = low


def ngram_join(docs: DataFrame, params: Forest = Forest(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, class_id, class_size, n_links, rep_id, n_shingles of each row.

    n_links counts the other rows whose set of word n-grams has at least the Jaccard similarity threshold; class_id is
    the least doc_id of the component that these links make, class_size its rows; rep_id the least doc_id of the rows
    with the very same set. A text of fewer words than n is one n-gram; one without words, or null, has no links. Null
    ids are rows like others (class_id null if all of a class are). Repeated rows are copies and link to each other.

    Rows of one set are merged before anything else, so a group of copies is a row however large. The labels of the
    sets are sorted in each tree of the forest; neighbours that share a prefix are candidates, the prefix being
    shortened until the recall is reached (_linked). Candidates whose sketches are like enough make clusters; the sets
    of a cluster are dealt in blocks, and each pair of blocks is compared exactly by a task of its own, which returns
    counts and a spanning edge per set, never the pairs. Very long texts are sets like others. No rows give no rows;
    columns of other names are not read.
    """
    one_thread(docs.sparkSession)
    links, sets, rows = _links(docs, params, id_col, text_col)
    roots = components(links.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    near = links.groupBy("rep").agg(F.sum("links").alias("links"))
    sets = sets.join(near, "rep", "left").join(roots.withColumnRenamed("v", "rep"), "rep", "left")
    sets = sets.select("k1", "k2", "n", F.col("id").alias("rep_id"), F.coalesce("root", "rep").alias("root"), "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    sets = stored(sets, "join-sets")
    classes = sets.groupBy("root").agg(F.min("rep_id").alias("class_id"), F.sum("copies").alias("class_size"))
    sets = sets.join(classes, "root").withColumnsRenamed({"n": "n_shingles"})
    one = [rows["k1"] == sets["k1"], rows["k2"] == sets["k2"], rows["n"] == sets["n_shingles"], rows["n"] > 0]
    out = rows.join(sets, one, "left")
    empty = F.col("rep_id").isNull() & F.col("class_size").isNull()
    return out.select(
        rows["id"].alias("doc_id"), F.when(empty, rows["id"]).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(empty, rows["id"]).otherwise(F.col("rep_id")).alias("rep_id"), rows["n"].alias("n_shingles"),
    )


def _links(docs: DataFrame, p: Forest, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rep, links, root by pair of blocks; distinct sets; rows)."""
    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).alias("text"))

    def signed(batches):
        for batch in batches:
            for at, part in slices(batch.column(2)):
                s, bounds = shingles(Words(part), p.words)
                k1, k2 = _identity(s, bounds)
                labels, sketches = _signatures(s, bounds, p)
                ends = pa.array(np.arange(len(part) + 1, dtype=np.int32) * p.trees)
                hi, lo = (pa.ListArray.from_arrays(ends, pa.array(labels[:, :, k].ravel())) for k in (0, 1))
                own = [batch.column(c).slice(at, len(part)) for c in (0, 1)]
                sketch = as_binary(sketches.ravel(), np.arange(len(part) + 1) * sketches.shape[1])
                yield pa.RecordBatch.from_arrays([*own, pa.array(k1), pa.array(k2), pa.array(np.diff(bounds).astype(np.int32)), hi, lo, sketch], ["id", "th", "k1", "k2", "n", "hi", "lo", "sketch"])

    rows = texts.mapInArrow(signed, f"id {kind}, th long, k1 long, k2 long, n int, hi array<long>, lo array<long>, sketch binary")
    rows = stored(rows.withColumn("row", F.monotonically_increasing_id()), "join-rows")
    sets = rows.filter("n > 0").groupBy("k1", "k2", "n").agg(F.min(F.struct("row", "id", "th")).alias("at"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("id"))
    sets = stored(sets.select("k1", "k2", "n", F.col("at.row").alias("rep"), F.col("at.id").alias("at_id"), F.col("at.th").alias("at_th"), "copies", "id"), "join-reps")
    mine = stored(rows.join(sets.select("rep"), rows["row"] == sets["rep"], "left_semi").select(F.col("row").alias("rep"), "hi", "lo", "sketch"), "join-signed")
    labels = mine.select("rep", F.posexplode(F.arrays_zip("hi", "lo")).alias("tree", "x")).select("tree", "x.hi", "x.lo", "rep")
    pairs = stored(_neighbours(labels, p), "join-pairs")
    linked, _ = _linked(pairs, mine.select("rep", "sketch"), p)
    clusters = components(linked.select("a", "b"))
    for old in (mine, pairs):
        discard(old)
    sizes = clusters.groupBy("root").agg(F.count(F.lit(1)).alias("m"))
    blocks = F.ceil(F.col("m") / p.block).cast("int")
    members = clusters.join(sizes, "root").join(sets, clusters["v"] == sets["rep"]).select("rep", "copies", "at_id", "at_th", F.col("root").alias("cluster"), blocks.alias("blocks"))

    def gathered(batches):
        for batch in batches:
            for at, part in slices(batch.column(4)):
                s, bounds = shingles(Words(part), p.words)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(at, len(part)) for c in range(4)), as_binary(s, bounds)], ["rep", "copies", "cluster", "blocks", "grams"])

    # the text of a set is that of a row with the id and the hash of the text of its representative
    texts = texts.join(members, F.col("id").eqNullSafe(F.col("at_id")) & (F.col("th") == F.col("at_th"))).select("rep", "copies", "cluster", "blocks", "text")
    grams = texts.mapInArrow(gathered, "rep long, copies long, cluster long, blocks int, grams binary").dropDuplicates(["rep"])
    mine = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    dealt = grams.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("cluster", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "rep", "copies", "mine", "grams")
    threshold = Fraction(str(p.threshold))

    def compared(t):
        rep, copies, sides = (t[c].to_numpy() for c in ("rep", "copies", "mine"))
        order = np.argsort(rep)
        rep, copies, sides = rep[order], copies[order], sides[order]
        grams = t["grams"].combine_chunks().to_pylist()
        i, j, _ = compare([np.frombuffer(grams[k], np.uint64) for k in order], sides, t["i"][0].as_py() == t["j"][0].as_py(), threshold)
        links = np.bincount(i, copies[j], len(rep)) + np.bincount(j, copies[i], len(rep))
        some = links > 0
        root = rep[_roots(len(rep), i, j)]
        return pa.table({"rep": rep[some], "links": links[some].astype(np.int64), "root": root[some]})

    links = dealt.groupBy("cluster", "i", "j").applyInArrow(compared, "rep long, links long, root long")
    return stored(links, "join-links"), sets, rows


def drop_near_copies(docs: DataFrame, params: Forest = Forest(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each class, and rows that repeat an id and its text once. All columns are kept.

    A document is told by its id and the hash of its text, so null and repeated ids do no harm; of a class the one
    whose key is least stays. Null and empty texts are like nothing and stay. No rows give no rows.
    """
    key = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.hex(F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))))
    own, gone = fresh(docs, "_key"), fresh(docs, "_gone")
    marked = docs.withColumn(own, key)
    found = stored(ngram_join(marked, params, own, text_col).select("doc_id", "class_id"), "near-found")
    left = marked.join(found.filter("doc_id != class_id").select(F.col("doc_id").alias(gone)), F.col(own) == F.col(gone), "left_anti")
    if not found.filter("doc_id = class_id").groupBy("doc_id").count().filter("count > 1").isEmpty():
        left = left.dropDuplicates([own])
    return left.drop(own)
