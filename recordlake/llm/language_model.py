"""A log-bilinear language model over all words: classes in context, spellings within classes, both trained by noise-contrastive estimation."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, discard, held_out, one_thread, slices, stored

#: The end token as a word; no word holds a space.
END = " "
#: Classes: frequent words of their own, the end token among them, and kinds of all other words by their first two bytes.
WORDS, KINDS = 768, 256
#: Most frequent words whose counts are broadcast; the counts of all others are joined.
HEAD = 1 << 18
DIM = 32
#: Slots for the hashed contexts of each order of the spelling model, and its orders.
SLOTS, ORDERS = 1 << 12, 5
ROUNDS = 4
BATCH, NOISE = 1024, 64
RATE = 0.08
#: Examples that a task trains on in a round, about, by words and by bytes; and the least examples in all, for which a
#: small corpus is passed over again, up to PASSES times.
SHARD, SHARD_BYTES, LEAST, PASSES = 1 << 19, 1 << 20, 1 << 21, 4
FOLDS = 10
SMOOTH = 0.1
_U = np.uint64
_SPACE = 32


@dataclass
class Lbl:
    """score of symbol w in a context of features f: (sum of r[f]) @ q[w] + b[w]. seen: squared gradients by row."""

    r: np.ndarray
    q: np.ndarray
    b: np.ndarray
    seen: np.ndarray

    @staticmethod
    def start(features: int, unigram: np.ndarray, dim: int = DIM, seed: int = 3) -> Lbl:
        rng = np.random.default_rng(seed)
        mat = lambda n: (rng.standard_normal((n, dim)) * 0.1).astype(np.float32)
        return Lbl(mat(features), mat(len(unigram)), np.log(unigram).astype(np.float32), np.full(features + 2 * len(unigram), 1e-2, np.float32))

    def flat(self) -> np.ndarray:
        return np.concatenate([self.r.ravel(), self.q.ravel(), self.b, self.seen])

    def like(self, flat: np.ndarray) -> Lbl:
        """A model of the same shape from numbers as flat() gives them."""
        at = np.cumsum([self.r.size, self.q.size, self.b.size])
        r, q, b, seen = np.split(flat.astype(np.float32), at)
        return Lbl(r.reshape(self.r.shape), q.reshape(self.q.shape), b, seen)

    def copy(self) -> Lbl:
        return self.like(self.flat())

    def norms(self, features: np.ndarray) -> np.ndarray:
        """Log of the sum of exponentials over all symbols, in each context."""
        out = np.empty(len(features), np.float32)
        step = 1 << 12
        for i in range(0, len(features), step):
            s = self.r[features[i : i + step]].sum(1) @ self.q.T + self.b
            top = s.max(1)
            out[i : i + step] = top + np.log(np.exp(s - top[:, None]).sum(1))
        return out

    def train(self, features: np.ndarray, symbols: np.ndarray, unigram: np.ndarray, rng: np.random.Generator) -> None:
        """One pass of noise-contrastive steps over the examples in random order; noise symbols come from the unigram."""
        order = rng.permutation(len(symbols))
        noise_cum = np.cumsum(unigram)
        log_noise = np.log(NOISE * unigram).astype(np.float32)
        rows, k = len(self.r), len(self.q)
        for i in range(0, len(order), BATCH):
            f, w = features[order[i : i + BATCH]], symbols[order[i : i + BATCH]]
            z = np.searchsorted(noise_cum, rng.random(NOISE) * noise_cum[-1], side="right").clip(max=k - 1)
            h = self.r[f].sum(1)
            qw, qz = self.q[w], self.q[z]
            data = np.einsum("nd,nd->n", h, qw) + self.b[w] - log_noise[w]
            fake = h @ qz.T + self.b[z] - log_noise[z]
            gd = -1 / (1 + np.exp(np.clip(data, -30, 30)))
            gf = 1 / (1 + np.exp(-np.clip(fake, -30, 30)))
            gh = gd[:, None] * qw + gf @ qz
            wz = self._order(np.concatenate([w, z]))
            self._move(self.q, rows, wz, np.concatenate([gd[:, None] * h, gf.T @ h]))
            self._move(self.b, rows + k, wz, np.concatenate([gd, gf.sum(0)]))
            self._move(self.r, 0, self._order(f.ravel()), gh, f.shape[1])

    @staticmethod
    def _order(at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(order of places by what they are, where each one begins in it, which ones)."""
        order = np.argsort(at.astype(np.uint16), kind="stable")  # rows are fewer than 2 ** 16, which are sorted by radix
        at = at[order]
        first = np.flatnonzero(np.diff(at, prepend=-1))
        return order, first, at[first]

    def _move(self, to: np.ndarray, base: int, places: tuple[np.ndarray, np.ndarray, np.ndarray], g: np.ndarray, each: int = 1) -> None:
        """A step against the gradient g, a row of it for each places, with a rate for each by its squared gradients so far."""
        order, first, at = places
        g = np.add.reduceat(g[order // each], first, axis=0)
        size = (g * g).mean(1) if g.ndim == 2 else g * g
        self.seen[base + at] += size
        rate = (RATE / np.sqrt(self.seen[base + at])).astype(np.float32)
        to[at] -= (rate[:, None] if g.ndim == 2 else rate) * g


def _bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all words with a space after each, where each word begins and ends)."""
    if not len(words):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    flat = words.cast(pa.large_binary()).take(pa.array(np.arange(len(words))))
    bounds = np.frombuffer(flat.buffers()[1], np.int64)[: len(flat) + 1]
    raw = np.frombuffer(flat.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    return np.insert(raw, bounds[1:], _SPACE), bounds + np.arange(len(bounds))


def _before(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The ORDERS bytes before each byte within its word as one number, the nearest lowest; before a word stand spaces."""
    place = np.arange(len(raw)) - np.repeat(bounds[:-1], np.diff(bounds))
    out = np.zeros(len(raw), np.uint64)
    for k in range(1, ORDERS + 1):
        byte = np.full(len(raw), _SPACE, np.uint64)
        byte[k:] = np.where(place[k:] >= k, raw[:-k], _SPACE)
        out |= byte << _U(8 * (k - 1))
    return out


def _spelled(before: np.ndarray) -> np.ndarray:
    """Features of contexts: a row of the model for the last byte, the last two, and so on."""
    cols = []
    for k in range(1, ORDERS + 1):
        x = before & _U((1 << 8 * k) - 1)
        if k > 1:
            with np.errstate(over="ignore"):
                x = (x * _U(0x9E3779B97F4A7C15)) >> _U(64 - SLOTS.bit_length() + 1)
        cols.append(x.astype(np.int64) + (256 + (k - 2) * SLOTS if k > 1 else 0))
    return np.stack(cols, 1)


class Speller:
    """Probability of a word from its bytes, given its first two if they are a kind, and that it has no class of its own."""

    def __init__(self, model: Lbl, kinds: np.ndarray, own: pa.Array):
        self.model, self.kinds = model, kinds
        self.lost = np.zeros(KINDS)
        own = own.filter(pc.not_equal(own, END))
        p, kind = self._raw(own)
        taken = np.bincount(kind, np.exp(p), KINDS)
        pairs = np.array([x for x in np.flatnonzero(kinds >= 0) if x >> 8 != _SPACE], np.int64)
        if len(pairs):  # those that are a kind of their own are not spelled from the start
            taken[0] += np.exp(self._pairs(pairs)).sum()
        self.lost = np.log1p(-np.minimum(taken, 1 - 1e-6))

    def kind(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Kind of each word by its first two bytes; 0 for rare ones."""
        first = bounds[:-1]
        return np.maximum(self.kinds[(raw[first].astype(np.int64) << 8) | raw[first + 1]], 0)

    def _bits(self, before: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """Log probability of each byte after the bytes before it; every context is normalised once."""
        some, at = np.unique(before, return_inverse=True)
        f = _spelled(some)
        norm, out, step = self.model.norms(f), np.empty(len(symbols)), 1 << 16
        for i in range(0, len(symbols), step):
            a, w = at[i : i + step], symbols[i : i + step]
            out[i : i + step] = np.einsum("nd,nd->n", self.model.r[f[a]].sum(1), self.model.q[w]) + self.model.b[w] - norm[a]
        return out

    def _pairs(self, pairs: np.ndarray) -> np.ndarray:
        raw = np.stack([pairs >> 8, pairs & 255], 1).astype(np.uint8).ravel()
        bounds = np.arange(len(pairs) + 1) * 2
        return self._bits(_before(raw, bounds), raw).reshape(-1, 2).sum(1)

    def _raw(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw, bounds = _bytes(words)
        if not len(words):
            return np.empty(0), np.empty(0, np.int64)
        kind = self.kind(raw, bounds)
        p = np.zeros(len(words))
        word = np.repeat(np.arange(len(words)), np.diff(bounds))
        step = 1 << 20
        before = _before(raw, bounds)
        given = (np.arange(len(raw)) - bounds[word] < 2) & (kind[word] > 0)
        for i in range(0, len(raw), step):
            k = slice(i, i + step)
            bits = self._bits(before[k], raw[k])
            p += np.bincount(word[k], np.where(given[k], 0.0, bits), len(words))
        return p, kind

    def log_share(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(log probability of each word within its kind, kind) of words without a class of their own."""
        p, kind = self._raw(words)
        return p - self.lost[kind], kind


def _tokens(part: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(vocabulary with END last, codes of all tokens, bounds of each text's tokens), END after each text's words."""
    w = Words(part, lower=True)
    end = len(w.vocab)
    codes = np.insert(w.codes.astype(np.int64), w.bounds[1:], end)
    return pa.concat_arrays([w.vocab.cast(pa.string()), pa.array([END])]), codes, w.bounds + np.arange(len(w.bounds))


def _contexts(classes: np.ndarray, bounds: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes two and one before each token; before a text stands the end token."""
    c1, c2 = np.full(len(classes), end), np.full(len(classes), end)
    c1[1:] = classes[:-1]
    c2[2:] = classes[:-2]
    first = bounds[:-1]
    c1[first] = c2[first] = end
    second = first + 1
    second = second[second < bounds[1:]]
    c2[second] = end
    return c2, c1


def _classes(vocab: pa.Array, own: pa.Array, kinds: np.ndarray) -> np.ndarray:
    """Class of each word: its own, from KINDS on, or its kind."""
    raw, bounds = _bytes(vocab)
    first = bounds[:-1]
    kind = np.maximum(kinds[(raw[first].astype(np.int64) << 8) | raw[np.minimum(first + 1, len(raw) - 1)]], 0)
    at = pc.index_in(vocab, own)
    return np.where(at.is_valid().to_numpy(zero_copy_only=False), pc.fill_null(at, 0).to_numpy(zero_copy_only=False) + KINDS, kind).astype(np.int64)


def _rounds(examples: DataFrame, model: Lbl, total: int, shard: int, parsed, unigram: np.ndarray) -> Lbl:
    """model after ROUNDS rounds over examples (round, ...), or more if they are few: every example is trained on.

    parsed gives (features, symbols) of a batch. In a round each task passes over its share of the round's examples;
    the state moves to the mean of the tasks' states, weighted by their examples. A state has a fixed size, and the
    states of any number of tasks are added up by groups of bounded size.
    """
    spark, block, fan = examples.sparkSession, 1 << 14, 64
    turns = ROUNDS * max(1, min(PASSES, math.ceil(LEAST / max(total, 1))))
    for turn in range(turns if total else 0):
        sent = spark.sparkContext.broadcast(model)

        def trained(batches, turn=turn, sent=sent):
            from pyspark import TaskContext

            task = TaskContext.get().partitionId()
            rng = np.random.default_rng((turn, task))
            m, n = sent.value.copy(), 0
            for batch in batches:
                for f, w in parsed(batch, rng):
                    m.train(f, w, unigram, rng)
                    n += len(w)
            if n:
                flat = m.flat().astype(np.float64) * n
                at = range(0, len(flat), block)
                yield pa.record_batch({"task": pa.array([task] * len(at), pa.int32()), "block": pa.array([i // block for i in at], pa.int32()), "n": pa.array([float(n)] * len(at)), "part": pa.array([(flat[i : i + block] / n).astype(np.float32).tobytes() for i in at], pa.binary())})

        def merged(t):
            n = t["n"].to_numpy()
            parts = np.stack([np.frombuffer(x.as_py(), np.float32) for x in t["part"]])
            return pa.table({"task": t["task"].slice(0, 1), "block": t["block"].slice(0, 1), "n": pa.array([float(n.sum())]), "part": pa.array([(n @ parts / n.sum()).astype(np.float32).tobytes()], pa.binary())})

        kind = "task int, block int, n double, part binary"
        mine = examples.filter(F.col("round") == turn % ROUNDS)
        tasks = max(1, math.ceil(total / ROUNDS / shard))
        got = mine.coalesce(tasks).mapInArrow(trained, kind)
        while tasks > 1:
            tasks = math.ceil(tasks / fan)
            got = got.withColumn("task", F.floor(F.col("task") / fan).cast("int")).groupBy("task", "block").applyInArrow(merged, kind)
        rows = sorted((r["block"], r["part"]) for r in got.collect())  # one state
        if rows:
            model = model.like(np.concatenate([np.frombuffer(x, np.float32) for _, x in rows]))
        sent.destroy()
    return model


class LanguageModel:
    """Counts of all training tokens (a table), the head of them, and the two log-bilinear models (arrays of fixed size).

    The probability of a word is that of its class after the classes of the two words before, times, if the class is a
    kind, that of its spelling: byte by byte after the ORDERS bytes before. Words that have a class of their own are
    taken out of a kind's mass; what the spellings of its training words leave over is the probability of a word of
    this kind that training has not seen. As in the base, unseen words are no different words, and all add up to 1.
    """

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = FOLDS):
        self.spark, self.id_col, self.text_col, self.folds = docs.sparkSession, id_col, text_col, folds
        one_thread(self.spark)
        training = docs.filter(~held_out(id_col, folds)).select(F.col(text_col).alias("text"))

        def counted(batches):
            for batch in batches:
                for _, part in slices(batch.column(0)):
                    vocab, codes, _ = _tokens(part)
                    n = np.bincount(codes, minlength=len(vocab))
                    some = np.flatnonzero(n)
                    yield pa.RecordBatch.from_arrays([vocab.take(pa.array(some)), pa.array(n[some])], ["word", "c"])

        counts = training.mapInArrow(counted, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))
        self.counts = stored(counts.withColumn("round", F.pmod(F.xxhash64("word"), F.lit(ROUNDS)).cast("int")), "lm-counts")
        self.n, self.v = (int(x or 0) for x in self.counts.agg(F.sum("c"), F.count(F.lit(1))).first())
        words, c, _ = self._head()
        self.head = words, c.astype(np.int64)
        self.own = pa.array([END, *[x for x in words.slice(0, WORDS).to_pylist() if x != END][: WORDS - 1]], pa.string())
        self.kinds, unigram = self._kinds()
        self.speller = Speller(self._spelling(), self.kinds, self.own)
        bare, (self.counts, self.unseen) = self.counts, self._spell()
        discard(bare)
        words, c, self.head_p = self._head()
        self.head = words, c.astype(np.int64)
        self.unigram, self.model = unigram, self._in_context(training, unigram)
        self.norms = self._norms()

    def _head(self) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """The most frequent words, their counts, descending, and log shares, once there are any; at most HEAD, cut between steps of the logarithm of the count.

        A count for each step finds the cut, so that no task sorts the vocabulary.
        """
        step = F.floor(F.log2("c") * 16).cast("int")
        least, total = None, 0
        for r in sorted(self.counts.groupBy(step.alias("step")).count().collect(), reverse=True):  # 16 for each doubling
            total += r["count"]
            if total > HEAD:
                break
            least = r["step"]
        got = self.counts.filter(step >= least) if least is not None else self.counts.limit(0)
        got = got.select("word", "c", "p" if "p" in got.columns else F.lit(0.0).alias("p")).toArrow().sort_by([("c", "descending"), ("word", "ascending")])  # at most HEAD rows
        return got["word"].combine_chunks(), got["c"].to_numpy(), got["p"].to_numpy()

    def _kinds(self) -> tuple[np.ndarray, np.ndarray]:
        """(kind of each pair of first bytes, -1 where it has none; share of each class among the tokens)."""
        n = np.ones(KINDS + WORDS)
        at = pc.index_in(self.own, self.head[0])
        found = at.is_valid().to_numpy(zero_copy_only=False)
        n[KINDS : KINDS + len(found)] += np.where(found, self.head[1][pc.fill_null(at, 0).to_numpy(zero_copy_only=False)], 0) if len(self.head[1]) else 0
        pair = F.substring(F.concat("word", F.lit(" ")).cast("binary"), 1, 2).alias("pair")
        tail = self.counts.filter(~F.col("word").isin(self.own.to_pylist())).groupBy(pair).agg(F.sum("c").alias("c")).collect()  # at most 65,536
        kinds = np.full(1 << 16, -1, np.int64)
        for k, r in enumerate(sorted(tail, key=lambda r: (-r["c"], bytes(r["pair"])))):
            own = k + 1 if k + 1 < KINDS else 0
            n[own] += r["c"]
            if own:
                kinds[int.from_bytes(r["pair"], "big")] = own
        return kinds, n / n.sum()

    def _spelling(self) -> Lbl:
        """The model of spellings: words without a class, drawn by their counts, as many draws as there are words."""
        own = self.own
        tail = self.counts.filter(~F.col("word").isin(own.to_pylist()))
        total, words = (int(x or 0) for x in tail.agg(F.sum(F.octet_length("word") + 1), F.count(F.lit(1))).first())

        def letters(batches):
            n = np.zeros(256)
            for batch in batches:
                raw, bounds = _bytes(batch.column(0))
                n += np.bincount(raw, np.repeat(batch.column(1).to_numpy(), np.diff(bounds)), 256)
            yield pa.record_batch({"symbol": pa.array(range(256), pa.int32()), "n": pa.array(n)})

        unigram = np.full(256, 1e-9)
        for r in tail.select("word", "c").mapInArrow(letters, "symbol int, n double").groupBy("symbol").agg(F.sum("n").alias("n")).collect():
            unigram[r["symbol"]] += r["n"]
        unigram[np.r_[:9, 14:32]] += 1e-6
        unigram /= unigram.sum()

        def drawn(batch, rng):
            c = batch.column(1).to_numpy().astype(float)
            cum = np.cumsum(c)
            some = np.searchsorted(cum, rng.random(len(c)) * cum[-1], side="right").clip(max=len(c) - 1)
            raw, bounds = _bytes(batch.column(0).take(pa.array(np.sort(some))))
            for i in range(0, len(raw), 1 << 20):
                lo = max(0, i - 64)
                word = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) if not i else word  # noqa: F821
                part = slice(i, i + (1 << 20))
                b = np.concatenate([[0], np.flatnonzero(np.diff(word[lo : i + (1 << 20)])) + 1, [len(word[lo : i + (1 << 20)])]])
                yield _spelled(_before(raw[lo : i + (1 << 20)], b)[i - lo :]), raw[part].astype(np.int64)

        return _rounds(tail.select("word", "c", "round"), Lbl.start(256 + (ORDERS - 1) * SLOTS, unigram), total, SHARD_BYTES, drawn, unigram)

    def _spell(self) -> tuple[DataFrame, np.ndarray]:
        """(the table of counts with the log share of each word in its kind, log of what the words of a kind leave over)."""
        own, sent = self.own, self.spark.sparkContext.broadcast(self.speller)

        def spelled(batches):
            for batch in batches:
                tail = pc.invert(pc.is_in(batch.column(0), own))
                p, kind = np.zeros(len(batch)), np.full(len(batch), -1)
                at = np.flatnonzero(tail.to_numpy(zero_copy_only=False))
                p[at], kind[at] = sent.value.log_share(batch.column(0).take(pa.array(at)))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array(kind.astype(np.int32))], ["word", "c", "p", "kind"])

        counts = stored(self.counts.select("word", "c").mapInArrow(spelled, "word string, c long, p double, kind int"), "lm-spelled")
        seen = np.zeros(KINDS)
        for r in counts.filter("kind >= 0").groupBy("kind").agg(F.sum(F.exp("p")).alias("p")).collect():  # KINDS rows
            seen[r["kind"]] = r["p"]
        return counts.drop("kind"), np.log(np.maximum(1 - seen, 1e-9))

    def _in_context(self, training: DataFrame, unigram: np.ndarray) -> Lbl:
        """The model of classes in context, trained on every token."""
        own, kinds, k = self.own, self.kinds, len(unigram)

        def coded(batches):
            for batch in batches:
                for _, part in slices(batch.column(0)):
                    vocab, codes, bounds = _tokens(part)
                    cls = _classes(vocab, own, kinds)[codes].astype(np.uint16)
                    turn = np.random.default_rng(len(codes)).permutation(len(part)) % ROUNDS
                    for t in range(ROUNDS):
                        mine = np.flatnonzero(turn == t)
                        if len(mine):
                            n = bounds[mine + 1] - bounds[mine]
                            take = np.repeat(bounds[mine] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                            yield pa.record_batch({"round": pa.array([t], pa.int32()), "codes": pa.array([cls[take].tobytes()], pa.binary())})

        def parsed(batch, rng):
            for x in batch.column(1):
                w = np.frombuffer(x.as_py(), np.uint16).astype(np.int64)
                bounds = np.concatenate([[0], np.flatnonzero(w == KINDS) + 1])
                c2, c1 = _contexts(w, bounds, KINDS)
                yield np.stack([c1, k + c2], 1), w

        rows = stored(training.mapInArrow(coded, "round int, codes binary"), "lm-codes")
        model = _rounds(rows, Lbl.start(2 * k, unigram), self.n, SHARD, parsed, unigram)
        discard(rows)
        return model

    def _norms(self) -> np.ndarray:
        """The norm of every pair of classes before a token, computed by tasks; classes squared numbers."""
        model, k = self.model, len(self.model.q)
        sent = self.spark.sparkContext.broadcast(model)

        def normed(batches):
            for batch in batches:
                out = [sent.value.norms(np.stack([np.arange(k), np.full(k, k + c)], 1)).tobytes() for c in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["id", "norms"])

        got = self.spark.range(0, k, 1, 16).mapInArrow(normed, "id long, norms binary").collect()  # k squared numbers
        sent.destroy()
        return np.stack([np.frombuffer(r["norms"], np.float32) for r in sorted(got)])

    def score(self, docs: DataFrame) -> DataFrame:
        """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row.

        score comes from the two models alone. Counts are for base_score, n_known, and whether a word is seen; words
        beyond the head are gathered by document and joined with the table of counts, which has the shares of their
        spellings. Their rows carry the share of an unseen word as p.
        """
        spark = self.spark
        sent = spark.sparkContext.broadcast((self.model, self.norms, self.kinds, self.own, self.unseen, *self.head, self.head_p))
        total = self.n + SMOOTH * (self.v + 1)
        kind = dict(docs.dtypes)[self.id_col]

        def scored(batches):
            model, norms, kinds, own, unseen, words, c, head_p = sent.value
            k = len(model.q)
            for batch in batches:
                for at, part in slices(batch.column(2)):
                    vocab, codes, bounds = _tokens(part)
                    found = pc.index_in(vocab, words)
                    known = found.is_valid().to_numpy(zero_copy_only=False)
                    found = pc.fill_null(found, 0).to_numpy(zero_copy_only=False)
                    n, spelled = (np.where(known, x[found] if len(x) else 0, 0) for x in (c, head_p))
                    cls = _classes(vocab, own, kinds)
                    w = cls[codes]
                    c2, c1 = _contexts(w, bounds, KINDS)
                    p = np.empty(len(w))
                    for i in range(0, len(w), 1 << 16):
                        j = slice(i, i + (1 << 16))
                        p[j] = np.einsum("nd,nd->n", model.r[c1[j]] + model.r[k + c2[j]], model.q[w[j]]) + model.b[w[j]] - norms[c2[j], c1[j]]
                    p = (p + spelled[codes]) / np.log(10)
                    base = np.where(known, np.log10((n + SMOOTH) / total), 0.0)
                    add = lambda x: np.add.reduceat(x, bounds[:-1])  # noqa: E731  each text has its end token
                    ids = batch.column(0).slice(at, len(part)), batch.column(1).slice(at, len(part))
                    m = len(part)
                    yield pa.RecordBatch.from_arrays([*ids, pa.nulls(m, pa.string()), pa.array(np.diff(bounds)), pa.array(add(known[codes].astype(np.int64))), pa.array(add(base[codes])), pa.array(add(p))], names)
                    rare = ~known[codes]
                    row = np.repeat(np.arange(m), np.diff(bounds))[rare]
                    key, times = np.unique(row * len(vocab) + codes[rare], return_counts=True)
                    row, word = pa.array(key // len(vocab)), pa.array(key % len(vocab))
                    other = pa.array(unseen[np.minimum(cls, KINDS - 1)] / np.log(10)).take(word)
                    yield pa.RecordBatch.from_arrays([ids[0].take(row), ids[1].take(row), vocab.take(word), pa.array(times), pa.nulls(len(key), pa.int64()), pa.nulls(len(key), pa.float64()), other], names)

        names = ["row", "doc_id", "word", "n", "known", "base", "p"]
        rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(self.id_col).alias("doc_id"), F.col(self.text_col).alias("text"))
        rows = stored(rows.mapInArrow(scored, f"row long, doc_id {kind}, word string, n long, known long, base double, p double"), "lm-scores")
        share = F.col("n") * F.log10((F.coalesce("c", F.lit(0)) + F.lit(SMOOTH)) / F.lit(total))
        rare = rows.filter(F.col("word").isNotNull()).join(self.counts.select("word", "c", (F.col("p") / F.lit(math.log(10))).alias("share")), "word", "left")
        rare = rare.groupBy("row").agg(F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("r_known"), F.sum(share).alias("r_base"), F.sum(F.col("n") * F.coalesce("share", "p")).alias("r_p"))
        out = rows.filter(F.col("word").isNull()).join(rare, "row", "left")
        zero = lambda c: F.coalesce(c, F.lit(0))
        return out.select(
            "doc_id", held_out("doc_id", self.folds).alias("held_out"), F.col("n").alias("n_tokens"), (F.col("known") + zero("r_known")).alias("n_known"), F.lit(self.n).cast("long").alias("train_tokens"),
            (F.col("base") + zero("r_base")).alias("base_score"), (F.col("p") + zero("r_p")).alias("score"),
        )


def language_scores(docs: DataFrame) -> DataFrame:
    """Train on the documents whose fold is not held out and score all of them, whole texts; see LanguageModel.score.

    A null or empty text is an end token alone; rows that repeat are scored each; a null id trains and is not held out.
    Very long texts and words are scored whole, in pieces. Other columns are not read, whatever their names. Without
    training rows the models are those at the start; no rows give no rows.
    """
    return LanguageModel(docs).score(docs)
