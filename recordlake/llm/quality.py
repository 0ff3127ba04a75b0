"""Quality: a generalised additive model with pairwise interactions, fitted by cyclic boosting of shallow trees."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Words, held_out, mix, slices
from .labelled import FOLDS, MAX_ROWS, sample

BINS = 48
COARSE = 8
ROUNDS = 150
PAIR_ROUNDS = 60
PAIRS = 6
RATE = 0.15
THRESHOLD = 0.3
_U = np.uint64
#: Bytes whose share of a text is a feature.
CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "stop": b".", "comma": b",;:", "shout": b"!?", "symbol": b"#$%&*+<=>@^_`~\\", "bar": b"|/[]{}()",
    "line": b"\n", "space": b" \t\r\v\f", "other": bytes(range(128, 256)),
}
NAMES = (*CLASSES, "log_words", "word_bytes", "distinct", "distinct_pairs", "same_next", "same_after_next", "short", "ends")


def measures(texts: pa.Array) -> np.ndarray:
    """A row of NAMES for each text; an empty text has zeros."""
    texts = pc.fill_null(texts, "")
    w = Words(texts)
    texts = pa.concat_arrays([texts.take(pa.array(np.arange(len(texts))))])
    raw = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
    starts = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    full = np.flatnonzero(ends > starts)
    out = np.zeros((len(texts), len(NAMES)))
    size = np.maximum(ends - starts, 1)
    if len(full):
        for k, chars in enumerate(CLASSES.values()):
            of = np.zeros(256, np.uint8)
            of[np.frombuffer(chars, np.uint8)] = 1
            out[full, k] = np.add.reduceat(of[raw[: ends[-1]]], starts[full], dtype=np.int64) / size[full]
    n, row, codes = w.counts, w.rows(), w.codes.astype(np.int64)
    some = np.maximum(n, 1)
    v = pc.binary_length(w.vocab).to_numpy(zero_copy_only=False) if len(w.vocab) else np.empty(0, int)
    last = np.array([x[-1:] in ".!?" and x != "" for x in w.vocab.to_pylist()], bool) if len(w.vocab) else np.empty(0, bool)
    k = len(CLASSES)

    def distinct(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            u, at = np.unique(mix(keys.astype(np.uint64) + (rows.astype(np.uint64) << _U(44))), return_index=True)
        return np.bincount(rows[at], minlength=len(texts))

    out[:, k] = np.log1p(n)
    if len(codes):
        out[:, k + 1] = np.bincount(row, v[codes], len(texts)) / some
        out[:, k + 2] = distinct(codes, row) / some
        ok = row[:-1] == row[1:]
        out[:, k + 3] = (distinct((codes[:-1] << 22) ^ codes[1:], row[:-1]) + (n > 0)) / some
        out[:, k + 4] = np.bincount(row[:-1][ok & (codes[:-1] == codes[1:])], minlength=len(texts)) / some
        out[:, k + 5] = np.bincount(row[:-2][(row[:-2] == row[2:]) & (codes[:-2] == codes[2:])], minlength=len(texts)) / some if len(codes) > 2 else 0
        out[:, k + 6] = np.bincount(row[v[codes] <= 3], minlength=len(texts)) / some
        out[:, k + 7] = np.bincount(row[last[codes]], minlength=len(texts)) / some
    return out


@dataclass
class Gam:
    """Lookup tables: the score of a row is bias + table[f][bin of f] + pair table[cell], through a logistic."""

    bias: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def score(self, x: np.ndarray) -> np.ndarray:
        s = np.full(len(x), self.bias)
        bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(self.edges)]
        for t, b in zip(self.tables, bins, strict=True):
            s += t[b]
        for (a, b), t in zip(self.pairs, self.pair_tables, strict=True):
            s += t[self.coarse[a][bins[a]], self.coarse[b][bins[b]]]
        return 1 / (1 + np.exp(-np.clip(s, -30, 30)))


def _best_split(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, int]:
    """(gain, bins left of the cut) of the best cut of a run of bins."""
    gl, hl = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - g.sum() ** 2 / (h.sum() + ridge)
    gain = np.where((hl > 0.5) & (hr > 0.5), gain, -1.0)
    k = int(np.argmax(gain)) if len(gain) else 0
    return (float(gain[k]), k + 1) if len(gain) else (-1.0, 0)


def shallow_tree(g: np.ndarray, h: np.ndarray, rate: float, ridge: float = 1.0, leaves: int = 3) -> np.ndarray:
    """Newton steps of a tree of few leaves over ordered bins, as a value for each bin."""
    parts = [(0, len(g))]
    while len(parts) < leaves:
        cuts = [(*_best_split(g[a:b], h[a:b], ridge), a, b) for a, b in parts]
        gain, k, a, b = max(cuts)
        if gain <= 1e-6:
            break
        parts.remove((a, b))
        parts += [(a, a + k), (a + k, b)]
    out = np.zeros(len(g))
    for a, b in parts:
        out[a:b] = -rate * g[a:b].sum() / (h[a:b].sum() + ridge)
    return out


def pair_tree(g: np.ndarray, h: np.ndarray, rate: float, ridge: float = 1.0) -> tuple[float, np.ndarray]:
    """(gain, values) of the best tree that cuts a grid once by its rows and each side by its columns."""
    best, out = 0.0, np.zeros_like(g)
    base = g.sum() ** 2 / (h.sum() + ridge)
    for k in range(1, len(g)):
        gain, values = -base, np.zeros_like(g)
        for rows in (slice(0, k), slice(k, None)):
            gs, hs = g[rows].sum(0), h[rows].sum(0)
            more, cut = _best_split(gs, hs, ridge)
            gain += gs.sum() ** 2 / (hs.sum() + ridge) + max(more, 0)
            for cols in (slice(0, cut), slice(cut, None)) if more > 0 else (slice(None),):
                values[rows, cols] = -rate * gs[cols].sum() / (hs[cols].sum() + ridge)
        if gain > best:
            best, out = gain, values
    return best, out


def fit_gam(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, pair_rounds: int = PAIR_ROUNDS, pairs: int = PAIRS, rate: float = RATE) -> Gam:
    """Boost the features in turn, a tree each, round after round; then the pairs whose grids still explain most."""
    prior = min(max(float(y.mean()) if len(y) else 0.5, 1e-3), 1 - 1e-3)
    m = Gam(float(np.log(prior / (1 - prior))), [], [])
    bins = []
    for f in range(x.shape[1]):
        e = np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.empty(0)
        m.edges.append(e)
        m.tables.append(np.zeros(len(e) + 1))
        m.coarse.append((np.arange(len(e) + 1) * COARSE // (len(e) + 1)).astype(np.int64))
        bins.append(np.searchsorted(e, x[:, f], side="right"))
    if not len(x) or y.min() == y.max():
        return m
    s = np.full(len(y), m.bias)

    def slopes() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-s))
        return p - y, p * (1 - p)

    for _ in range(rounds):
        for f, b in enumerate(bins):
            g, h = slopes()
            step = shallow_tree(np.bincount(b, g, len(m.tables[f])), np.bincount(b, h, len(m.tables[f])), rate)
            m.tables[f] += step
            s += step[b]
    spread = [np.sqrt(np.mean((t[b] - t[b].mean()) ** 2)) for t, b in zip(m.tables, bins, strict=True)]
    top = sorted(np.argsort(spread)[::-1][:10].tolist())
    cells = {(i, j): m.coarse[i][bins[i]] * COARSE + m.coarse[j][bins[j]] for i in top for j in top if i < j}
    grid = lambda c, v: np.bincount(c, v, COARSE * COARSE).reshape(COARSE, COARSE)
    g, h = slopes()
    m.pairs = sorted(cells, key=lambda p: -pair_tree(grid(cells[p], g), grid(cells[p], h), rate)[0])[:pairs]
    m.pair_tables = [np.zeros((COARSE, COARSE)) for _ in m.pairs]
    for _ in range(pair_rounds):
        for k, p in enumerate(m.pairs):
            g, h = slopes()
            step = pair_tree(grid(cells[p], g), grid(cells[p], h), rate)[1]
            m.pair_tables[k] += step
            s += step.ravel()[cells[p]]
    return m


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_ROWS) -> Gam:
    """The model of at most max_rows labelled rows: tasks measure the texts, the driver gets len(NAMES) numbers a row."""

    def measured(batches):
        for batch in batches:
            for at, part in slices(batch.column(0)):
                x = measures(part)
                yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(NAMES)).cast(pa.list_(pa.float64())), batch.column(1).slice(at, len(part))], ["x", "label"])

    rows = sample(docs, labels, label, max_rows).mapInArrow(measured, "x array<double>, label int").toArrow()
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(-1, len(NAMES)) if rows.num_rows else np.zeros((0, len(NAMES)))
    return fit_gam(x, rows["label"].to_numpy().astype(float))


def score(docs: DataFrame, model: Gam, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted of each row, whole text. A null text counts as empty; repeated rows are scored each."""

    def scored(batches):
        for batch in batches:
            for at, part in slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(part)), pa.array(model.score(measures(part)))], ["doc_id", "score"])

    kind = dict(docs.dtypes)[id_col]
    out = docs.select(F.col(id_col), F.col(text_col)).mapInArrow(scored, f"doc_id {kind}, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of each document.

    Without labelled rows every score is 0.5. A null text counts as empty, and all empty texts have one score; very long
    ones are measured whole. Null ids are scored and not held out; rows that repeat are scored each. Other columns are
    not read, whatever their names. No rows give no rows.
    """
    out = score(docs, fit(docs, labels, max_rows=max_rows))
    return out.select("doc_id", held_out("doc_id", FOLDS).alias("held_out"), "score", "predicted")


def drop_poor(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """docs less those that the model rejects. All columns are kept; a null id is judged by its text like others."""
    model = fit(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def kept(batches):
        for batch in batches:
            ok = np.concatenate([sent.value.score(measures(part)) >= THRESHOLD for _, part in slices(batch.column(at))] or [np.empty(0, bool)])
            yield batch.filter(pa.array(ok))

    return docs.mapInArrow(kept, docs.schema)
