"""The Merkle manifest against plain recursion."""

import random
import zlib
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from recordlake.llm import merkle

from .helpers import frame

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, extra string, n int, i string, lefts string"


def h(x):
    return sha256(x.encode() if isinstance(x, str) else x).hexdigest()


def leaf(row, text=None):
    row = (*row[:4], text if text is not None else row[4])
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][k : k + 8])) for k in range(0, len(out[-1]), 8)])
    return out


def path(levels, i):
    out = []
    for nodes in levels[:-1]:
        lo = i - i % 8
        out.append((nodes[lo:i], nodes[i + 1 : lo + 8]))
        i //= 8
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    trees, places = {}, {}
    for g, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[g], places[g] = levels_of([leaf(r) for r in own]), own
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    top = levels_of([trees[g][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        for i, r in enumerate(places[g]):
            steps = path(trees[g], i) + path(top, k)
            wrong = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            cur = leaf(r, "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])) if wrong else leaf(r)
            for left, right in steps:
                cur = h("".join(left) + cur + "".join(right))
            out.append((r[0], leaf(r), trees[g][-1][0], top[-1][0], h("".join("".join(a + b) for a, b in steps)), cur, cur == top[-1][0]))
    return out, trees


def sample(n, langs, seed=3):
    rng = random.Random(seed)
    rows = [(k, rng.choice(["hot", "hot", "b", None]), rng.choice(langs), rng.choice([None, k]), rng.choice(["Aé Z" + str(k), "lower", "", None])) for k in rng.sample(range(-50, 10 * n + 10), n)]
    if n > 3:
        rows += [(None, "x", langs[0], 1, "Q"), (None, "x", langs[0], 1, "R"), rows[0], rows[0], rows[1], (rows[2][0], "other", rows[2][2], 0, "T"), (7, "l", "one", 1, "W" * 100_000)]
    return rows


@pytest.mark.parametrize(("n", "langs", "levels"), [(700, ["en", "en", "en", None], 1), (90, ["é", "Z", "a", ""], 3), (1, ["en"], 3), (60, [f"l{k}" for k in range(30)], 1), (1400, ["en"], 3)])
def test_proofs(spark, n, langs, levels):
    """Several rounds of builders and one; many groups; null and repeated ids, null columns, repeated rows, a long text; clashing names."""
    rows = sample(n, langs)
    docs = spark.createDataFrame([(*r, "x", 1, "y", "z") for r in rows], SCHEMA).repartition(3)
    where = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    m = merkle.Manifest(docs, tampered={"text": merkle.lower_ascii(F.col("text"))}, where=where, levels=levels)
    got = m.proofs().collect()
    want, trees = brute(rows)
    assert Counter((r["id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"], r["folded_root"], r["verified"]) for r in got) == Counter(want)
    for r in got[:50]:  # the siblings that are returned lead from the leaf to the root
        cur = (r["tampered"] or r["leaf"]).encode()
        assert merkle.folded(cur, [bytes(x) for x in r["lefts"]], [bytes(x) for x in r["rights"]]).decode() == r["folded_root"]
    log = {}
    for r in m.log().collect():
        log.setdefault(r["group"], {})[r["position"]] = (r["level"], r["digest"])
    for g, tree in trees.items():  # each position once, nodes after all below them
        assert sorted(log[g]) == list(range(sum(map(len, tree))))
        assert [d for _, (lv, d) in sorted(log[g].items()) if lv == 0] == tree[0] and log[g][len(log[g]) - 1][1] == tree[-1][0]
        assert Counter(log[g].values()) == Counter((k, d) for k, nodes in enumerate(tree) for d in nodes)


def test_positions():
    """The closed form is where a plain builder puts its nodes."""
    for n in (1, 2, 7, 8, 9, 63, 64, 65, 511, 512):
        for levels in {merkle.height(n), 3}:
            leaves = [h(str(k)).encode() for k in range(n)]
            log, at, nodes = merkle.built(leaves, levels), merkle.positions(n, levels), leaves
            for level in range(levels + 1):
                assert [log[p] for p in at[level]] == nodes
                nodes = [merkle.node(nodes[k : k + 8]) for k in range(0, len(nodes), 8)]
            assert len(log) == sum(map(len, at))


def test_no_rows(spark):
    docs = frame(spark, [])
    assert merkle.manifest_proofs(docs).collect() == []
    m = merkle.Manifest(docs)
    assert m.root() is None and m.log().collect() == []
