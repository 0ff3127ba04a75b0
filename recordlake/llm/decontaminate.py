"""Benchmark decontamination: latent semantic search for passages of benchmark items, then longest common subsequences."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SPACE, Words, discard, fresh, one_thread, plain, slices, stored

_WORD = re.compile(f"[^{SPACE}]+")
_SENTENCE = re.compile(r"(?<=[.?!])\s+|\n+")


@dataclass(frozen=True)
class Search:
    """passage: words of an item's passage; a document is read in windows of two passages, a passage apart. group: most
    passages of the benchmark that share a latent space; rank: most dimensions of it, which are no more than a third of its
    passages. It is learned from them and from sample windows of the corpus, which weigh weight of them together; of the
    words of these windows, the vocabulary most frequent ones in them that at least two hold are words of the space.
    held: share of its energy that a passage must keep, or else it goes to the next space; the last few passages have a
    complete one. cosine: least latent similarity of a candidate; reach: share of a passage's latent weight that makes a
    window a candidate whatever else is in it. An item is found in a document if the longest common subsequence of their
    words has at least same of the item, or at least close of it and answer of its last sentence. items: benchmark items
    that are indexed and broadcast at a time."""

    passage: int = 32
    rank: int = 96
    group: int = 288
    sample: int = 2048
    vocabulary: int = 8192
    weight: float = 1.0
    held: float = 0.25
    oversample: int = 10
    iterations: int = 2
    cosine: float = 0.5
    reach: float = 0.5
    same: float = 0.8
    close: float = 0.65
    answer: float = 0.8
    items: int = 2048
    seed: int = 5


#: Passages that are too few for a latent space.
FEW = 16


def windows(w: Words, known: np.ndarray, features: int, passage: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(window of each pair, feature, times; text of each window, first word of each): words counted by window.

    known: feature of each word, or -1. A text's windows begin at every passage-th word; the last ends with the text.
    """
    blocks = -(-w.counts // passage)
    per = np.maximum(blocks - 1, (blocks > 0).astype(np.int64))
    first = np.concatenate([[0], np.cumsum(per)])
    row = w.rows()
    block = (np.arange(len(w.codes)) - w.bounds[row]) // passage
    some = known >= 0
    row, block, f = row[some], block[some], known[some]
    one, two = block < per[row], block > 0
    win = np.concatenate([(first[row] + block)[one], (first[row] + block - 1)[two]])
    key, times = np.unique(win * features + np.concatenate([f[one], f[two]]), return_counts=True)
    text = np.repeat(np.arange(len(per)), per)
    return key // features, key % features, times, text, (np.arange(len(text)) - first[text]) * passage


def randomised_svd(rows: DataFrame, n: int, rank: int, oversample: int, iterations: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(right singular vectors, n by at most rank; singular values) of the sparse rows (features, values: raw arrays).

    Tasks multiply their rows and the sums come back in blocks, so that the driver holds a few matrices of n by rank.
    """
    spark = rows.sparkSession
    block = 4096
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((n, min(n, rank + oversample))))[0].astype(np.float32)

    def summed(t):
        total = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in t["part"])
        return pa.table({"block": t["block"].slice(0, 1), "part": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    def product(small: bool) -> np.ndarray:
        sent = spark.sparkContext.broadcast(q)

        def partial(batches):
            q = sent.value
            out = np.zeros((q.shape[1] if small else n, q.shape[1]), np.float64)
            for batch in batches:
                for f, v in zip(*(batch.column(c).to_pylist() for c in (0, 1)), strict=True):
                    f, v = np.frombuffer(f, np.int32), np.frombuffer(v, np.float32)
                    y = v @ q[f]
                    if small:
                        out += np.outer(y, y)
                    else:
                        out[f] += v[:, None] * y
            at = range(0, len(out), block)
            yield pa.record_batch({"block": pa.array([i // block for i in at], pa.int32()), "part": pa.array([out[i : i + block].astype(np.float32).tobytes() for i in at], pa.binary())})

        kind = "block int, part binary"
        got = sorted(rows.select("features", "values").mapInArrow(partial, kind).groupBy("block").applyInArrow(summed, kind).collect())  # n by rank numbers
        sent.destroy()
        return np.concatenate([np.frombuffer(r["part"], np.float32) for r in got]).reshape(-1, q.shape[1])

    for _ in range(iterations + 1):
        q = np.linalg.qr(product(False))[0].astype(np.float32)
    values, turn = np.linalg.eigh(product(True).astype(np.float64))
    top = np.argsort(values)[::-1][:rank]
    return (q @ turn[:, top]).astype(np.float32), np.sqrt(np.maximum(values[top], 0))


def common_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, a bit of a whole number for each element of a."""
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for y in b:
        hit = row & places.get(y, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _plain_words(text: str) -> list[str]:
    return [x for x in plain(pa.array(_WORD.findall(text), pa.string())).to_pylist() if x]


def window_counts(texts: DataFrame, passage: int) -> DataFrame:
    """(word, n): how many windows of all texts hold each word; the word "" stands for all windows."""

    def counted(batches):
        for batch in batches:
            for _, part in slices(batch.column(0)):
                w = Words(part)
                coded = plain(w.vocab).dictionary_encode()
                known, vocab = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
                void = pc.index(vocab, pa.scalar("", vocab.type)).as_py()
                known = np.where(known == void, -1, known)[w.codes]
                _, f, _, text, _ = windows(w, known, max(len(vocab), 1), passage)
                n = np.bincount(f, minlength=len(vocab))
                some = np.flatnonzero(n)
                words = pa.concat_arrays([vocab.take(pa.array(some)).cast(pa.string()), pa.array([""])])
                yield pa.RecordBatch.from_arrays([words, pa.array(np.append(n[some], len(text)))], ["word", "n"])

    return texts.mapInArrow(counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass
class _Space:
    """basis: a row for each word of the index; vectors: directions of the passages in it; sizes: how long their weights
    are there; owner: their items; inside: which words a complete space has, or None."""

    basis: np.ndarray
    vectors: np.ndarray
    sizes: np.ndarray
    owner: np.ndarray
    inside: np.ndarray | None


class _Index:
    """A block of items: their passages as latent vectors, and what is sent to the tasks. counts: see window_counts."""

    def __init__(self, spark: SparkSession, items: list[tuple], texts: DataFrame, n_texts: int, counts: DataFrame, p: Search):
        words = [_plain_words(t or "") for _, t in items]
        last = [[s for s in _SENTENCE.split((t or "").strip()) if _WORD.search(s)] for _, t in items]
        own = pa.array(sorted({x for w in words for x in w}), pa.string())
        sampled = self._sampled(texts, n_texts, own, p) if len(own) and p.sample else []
        often = Counter(x for w, _ in sampled for x in w)
        often = sorted(((x, n) for x, n in often.items() if n > 1), key=lambda x: (-x[1], x[0]))[: p.vocabulary]
        vocab = sorted({*own.to_pylist(), *(x for x, _ in often)})
        self.vocab = pa.array(vocab, pa.string())
        of = {x: k for k, x in enumerate(vocab)}
        self.items = [(i, [of[x] for x in w]) for (i, _), w in zip(items, words, strict=True)]
        self.answers = [[of[x] for x in _plain_words(s[-1])] if s else [] for s in last]
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.holds, self.times = np.unique(np.array([k * (len(vocab) + 1) + f for k, (_, w) in enumerate(self.items) for f in w], np.int64), return_counts=True)
        df, total = np.zeros(len(vocab)), 0
        wanted = spark.createDataFrame(pa.table({"word": pa.array([*vocab, ""], pa.string())}))  # the index's words
        for word, n in zip(*(c.to_pylist() for c in counts.join(F.broadcast(wanted), "word").select("word", "n").toArrow().columns), strict=True):
            if word:
                df[of[word]] = n
            else:
                total = n
        self.idf = np.log((1 + total) / (1 + df) + 1e-9).clip(min=1e-3).astype(np.float32)
        rows = []
        for k, (_, mine) in enumerate(self.items):
            parts = max(1, math.ceil(len(mine) / p.passage))
            for j in range(parts if mine else 0):
                f, tf = np.unique(mine[j * len(mine) // parts : (j + 1) * len(mine) // parts], return_counts=True)
                rows.append((k, f, ((1 + np.log(tf)) * self.idf[f]).astype(np.float32)))
        around = []
        for w, times in sampled:
            some = [(of[x], t) for x, t in zip(w, times, strict=True) if x in of]
            f = np.array([x for x, _ in some], np.int64)
            if some:
                around.append((f, ((1 + np.log([t for _, t in some])) * self.idf[f]).astype(np.float32)))
        self.spaces = []
        while len(rows) > FEW and around:
            rest = []
            for part in _dealt(rows, p.group):
                space, kept = self._space(spark, part, p, min(p.rank, len(part) // 3), around)
                self.spaces += [space] if kept.any() else []
                rest += [r for r, k in zip(part, kept, strict=True) if not k]
            if len(rest) == len(rows):
                break
            rows = rest
        self.spaces += [self._space(spark, part, p, len(part), [])[0] for part in _dealt(rows, max(p.rank, FEW))]
        self.bundles = [(np.concatenate([x.basis for x in some], axis=1), some) for some in _bundled(self.spaces)]
        for x in self.spaces:
            x.basis = x.basis[:, :0]  # it is in its bundle

    @staticmethod
    def _sampled(texts: DataFrame, n_texts: int, own: pa.Array, p: Search) -> list[tuple[list, list]]:
        """(words, times) of p.sample different windows of the corpus that hold a word of the benchmark, the first by a hash."""
        some = max(1, n_texts // p.sample)

        def cut(batches):
            for batch in batches:
                for _, part in slices(batch.column(0)):
                    w = Words(part)
                    coded = plain(w.vocab).dictionary_encode()
                    vocab = coded.dictionary
                    known = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                    void = pc.index(vocab, pa.scalar("", vocab.type)).as_py()
                    win, f, times, text, _ = windows(w, np.where(known == void, -1, known)[w.codes], max(len(vocab), 1), p.passage)
                    theirs = pc.is_in(vocab, own.cast(vocab.type)).to_numpy(zero_copy_only=False)
                    keep = np.bincount(win[theirs[f]], minlength=len(text))[win] > 0
                    win, f, times = win[keep], f[keep], times[keep]
                    bounds = pa.array(np.append(np.flatnonzero(np.diff(win, prepend=-1)), len(win)).astype(np.int32))
                    words = vocab.take(pa.array(f)).cast(pa.string())
                    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(bounds, words), pa.ListArray.from_arrays(bounds, pa.array(times.astype(np.int32)))], ["words", "times"])

        found = texts.filter(F.pmod(F.xxhash64("text"), F.lit(some)) == 0).mapInArrow(cut, "words array<string>, times array<int>")
        found = found.select(F.array_sort(F.arrays_zip("words", "times")).alias("w")).distinct()
        return [([x["words"] for x in r["w"]], [x["times"] for x in r["w"]]) for r in found.orderBy(F.xxhash64("w"), "w").limit(p.sample).collect()]  # p.sample windows

    def _space(self, spark: SparkSession, rows: list[tuple], p: Search, rank: int, around: list[tuple]) -> tuple[_Space, np.ndarray]:
        """(the latent space of passages and windows around, which passages it keeps); without windows it is complete."""
        own = np.unique(np.concatenate([f for _, f, _ in rows] + [f for f, _ in around]))
        place = np.full(len(self.vocab), -1, np.int32)
        place[own] = np.arange(len(own))
        sizes = np.array([np.linalg.norm(v) for _, _, v in rows], np.float32)
        unit = [(place[f], v / size) for (_, f, v), size in zip(rows, sizes, strict=True)]
        share = math.sqrt(p.weight * len(rows) / max(len(around), 1))
        other = [(place[f], v * (share / np.linalg.norm(v))) for f, v in around]
        both = unit + other
        table = pa.table({"features": pa.array([f.tobytes() for f, _ in both], pa.binary()), "values": pa.array([v.astype(np.float32).tobytes() for _, v in both], pa.binary())})
        basis, _ = randomised_svd(spark.createDataFrame(table), len(own), rank, p.oversample, p.iterations, p.seed)
        vectors = np.stack([v @ basis[f] for f, v in unit])
        length = np.linalg.norm(vectors, axis=1).clip(1e-9)
        kept = length**2 >= p.held if around else np.ones(len(rows), bool)
        owner = np.array([k for k, _, _ in rows], np.int64)
        whole = np.zeros((len(self.vocab), basis.shape[1]), np.float32)
        whole[own] = basis
        return _Space(whole, (vectors / length[:, None])[kept], (sizes * length)[kept], owner[kept], None if around else place >= 0), kept


def _bundled(spaces: list[_Space], most: int = 192) -> list[list[_Space]]:
    """spaces in runs of at most most dimensions together, or one, which windows are projected to at once."""
    out: list[list[_Space]] = []
    n = most + 1
    for x in spaces:
        if n + x.basis.shape[1] > most:
            out.append([])
            n = 0
        out[-1].append(x)
        n += x.basis.shape[1]
    return out


def _dealt(rows: list, most: int) -> list[list]:
    """rows in even parts of at most most."""
    groups = math.ceil(len(rows) / most)
    return [rows[g * len(rows) // groups : (g + 1) * len(rows) // groups] for g in range(groups)]


def _candidates(found: dict, basis: np.ndarray, spaces: list[_Space], win: np.ndarray, f: np.ndarray, value: np.ndarray, text: np.ndarray, first: np.ndarray, p: Search) -> None:
    """Add (first word, cosine) of each window to found[text, item] that lies near a passage, or reaches far enough along it.

    Both are told in the space: the window's words, those that the item does not have among them, say where it lies. In
    a complete space, which has the passages' words alone, a window is as long as the weights of these words.
    """
    starts = np.flatnonzero(np.diff(win, prepend=-1))
    used, ends = win[starts], np.append(starts[1:], len(win))
    step, few = 512, 16  # windows compared at a time, and projected at a time, which stay in a core's cache
    for i in range(0, len(used), step):
        to = min(i + step, len(used))
        lo, hi = starts[i], ends[to - 1]
        latent = np.empty((to - i, basis.shape[1]), np.float32)
        for k in range(i, to, few):
            first_pair, last = starts[k], ends[min(k + few, to) - 1]
            latent[k - i : k - i + few] = np.add.reduceat(value[first_pair:last, None] * basis[f[first_pair:last]], starts[k : min(k + few, to)] - first_pair)
        at = 0
        for x in spaces:
            own = latent[:, at : at + x.vectors.shape[1]]
            at += x.vectors.shape[1]
            norm = np.linalg.norm(own, axis=1) if x.inside is None else np.sqrt(np.add.reduceat(np.where(x.inside[f[lo:hi]], value[lo:hi] ** 2, 0), starts[i:to] - lo))
            along = own @ x.vectors.T
            for a, b in zip(*np.nonzero((along >= np.minimum(p.cosine * norm[:, None], p.reach * x.sizes)) & (along > 0)), strict=True):
                k = used[i + a]
                found.setdefault((int(text[k]), int(x.owner[b])), []).append((int(first[k]), float(along[a, b] / norm[a])))


def _search(part: pa.Array, x: _Index, p: Search) -> list[tuple]:
    """(text, item, cosine, share of the item, share of its answer, first word, end) of the items found in each text."""
    w = Words(part)
    known = pc.fill_null(pc.index_in(plain(w.vocab).cast(pa.string()), x.vocab), -1).to_numpy(zero_copy_only=False)[w.codes]
    win, f, times, text, first = windows(w, known, len(x.vocab), p.passage)
    value = (1 + np.log(times)).astype(np.float32) * x.idf[f]
    found: dict[tuple[int, int], list] = {}
    for basis, spaces in x.bundles:
        _candidates(found, basis, spaces, win, f, value, text, first, p)
    if not found:
        return []
    spans: list[tuple] = []  # text, item, first word, end, cosine
    for (t, item), at in found.items():
        mine, to = len(x.items[item][1]), int(w.bounds[t + 1] - w.bounds[t])
        # Windows of an item that touch are one region, up to eight times what one of them needs: a longer run is read in
        # regions that overlap, each with all of its windows and an item's length of words on both sides.
        runs: list[list] = []
        for s, c in sorted(at):
            lo, hi = max(0, s - mine), s + 2 * p.passage + mine
            if runs and lo <= runs[-1][1] and hi - runs[-1][0] <= 8 * (p.passage + mine):
                runs[-1][1], runs[-1][2] = hi, max(runs[-1][2], c)
            else:
                runs.append([lo, hi, c])
        spans += [(t, item, lo, min(hi, to), c) for lo, hi, c in runs]
    best: dict[tuple[int, int], tuple] = {}
    step = 1 << 12
    for i in range(0, len(spans), step):
        part_spans = spans[i : i + step]
        t, item, lo, hi = (np.array(c, np.int64) for c in list(zip(*part_spans, strict=True))[:4])
        n = hi - lo
        ends = np.cumsum(n)
        region = known[np.repeat(w.bounds[t] + lo - (ends - n), n) + np.arange(ends[-1])]
        key = np.repeat(item, n) * (len(x.vocab) + 1) + region
        at = np.searchsorted(x.holds, key).clip(max=len(x.holds) - 1)
        hit = (x.holds[at] == key) & (region >= 0)
        each, times = np.unique(np.repeat(np.arange(len(n)), n)[hit] * len(x.holds) + at[hit], return_counts=True)
        # No common subsequence is longer than the words that the region and the item share, repeats counted.
        shared = np.bincount(each // len(x.holds), np.minimum(times, x.times[each % len(x.holds)]), len(n))
        for k in np.flatnonzero(shared >= p.close * x.lengths[item]):
            mine, answer, words = x.items[item[k]][1], x.answers[item[k]], region[ends[k] - n[k] : ends[k]].tolist()
            share = common_length(mine, words) / len(mine)
            if share < p.close:
                continue
            told = common_length(answer, words) / len(answer) if answer else 0.0
            pair, c = (int(t[k]), int(item[k])), part_spans[k][4]
            if (share >= p.same or told >= p.answer) and (pair not in best or (share, c) > best[pair][:2]):
                best[pair] = share, c, told, int(lo[k]), int(hi[k])
    out = [(*pair, c, share, told, lo, hi) for pair, (share, c, told, lo, hi) in best.items()]
    return sorted(out)


def contaminated(docs: DataFrame, benchmark: DataFrame, params: Search = Search(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, cosine, lcs_share, answer_share, from_word, to_word of each item found in each document.

    Weights are inverse frequencies over the windows of all documents, counted once. Latent spaces come from randomised
    SVDs of TF-IDF rows: passages of the benchmark and sampled windows of the corpus, over the words of both. A space has
    at most a third as many dimensions as passages; those of which it keeps too little go to the next one. Every window of
    every document is projected and compared there with every passage, in blocks; those near one, and those that reach
    far along it, are candidates for the longest common subsequence of the item and the words around. The benchmark is indexed
    params.items at a time, so what is broadcast is bounded. Words are compared in lower case without punctuation at
    their ends. Null or empty texts match nothing, very long ones are read whole; an item given again, or a document
    given again, is found again; null ids are ids. Other columns are not read, whatever their names. No documents or no
    items: no rows.
    """
    spark = docs.sparkSession
    one_thread(spark)
    texts = docs.select(F.col(text_col).alias("text"))
    items = benchmark.select("item_id", "text")
    kind, item_kind = dict(docs.dtypes)[id_col], dict(benchmark.dtypes)["item_id"]
    schema = f"doc_id {kind}, item_id {item_kind}, cosine double, lcs_share double, answer_share double, from_word int, to_word int"
    blocks = max(1, math.ceil(items.count() / params.items))
    counts, n_texts = stored(window_counts(texts, params.passage), "leak-words"), texts.count()
    out = None
    for b in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()  # about params.items rows
        index = _Index(spark, [(r["item_id"], r["text"]) for r in own], texts, n_texts, counts, params)
        ids = pa.array([r["item_id"] for r in own])
        sent = spark.sparkContext.broadcast((index, ids))

        def searched(batches, sent=sent):
            index, ids = sent.value
            for batch in batches:
                for at, part in slices(batch.column(1)):
                    rows = _search(part, index, params) if index.spaces else []
                    cols = list(zip(*rows, strict=True)) or [[]] * 7
                    kinds = (pa.float64(), pa.float64(), pa.float64(), pa.int32(), pa.int32())
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array([at + t for t in cols[0]], pa.int64())), ids.take(pa.array(cols[1], pa.int64())), *(pa.array(c, k) for c, k in zip(cols[2:], kinds, strict=True))], ["doc_id", "item_id", "cosine", "lcs_share", "answer_share", "from_word", "to_word"])

        found = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(searched, schema)
        out = found if out is None else out.unionAll(found)
    discard(counts)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, params: Search = Search(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs less those in which an item of the benchmark is found. All columns are kept.

    A document is told by its id and the hash of its text, so a null or repeated id loses only the rows whose own text
    holds an item.
    """
    own, gone = fresh(docs, "_own"), fresh(docs, "_found")
    key = F.concat_ws(":", F.col(id_col).cast("string"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    marked = docs.withColumn(own, key)
    found = stored(contaminated(marked, benchmark, params, own, text_col).select(F.col("doc_id").alias(gone)).distinct(), "leaks")
    return marked.join(found, F.col(own) == F.col(gone), "left_anti").drop(own)
