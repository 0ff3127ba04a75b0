"""The prefix trie of conversations against a plain one."""

import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import pytest

from recordlake.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, ids string, depth int, open string"


def brute(rows, rebuilt):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((turn is not None, turn or 0, sha256(f"{len(role.encode())}:{role}{text}".encode()).digest(), role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in turns.items()}
    seqs = dict(own)
    if rebuilt:
        for c in own:
            h = zlib.crc32(str(c).encode()) % 9
            base = c - int(c - 5 * int(c / 5))
            seqs[c] = own.get(base, [])[:h] + own[c][h:]
    nodes = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes[tuple(s[:d])].append(c)
    kids = Counter(p[:-1] for p in nodes if p)
    leaves, saved = Counter(), Counter()
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += p not in kids
            saved[p[:d]] += (len(members) - 1) * (len(p[-1][1].encode()) if p else 0)
    out = []
    for p, m in nodes.items():
        ends = ",".join(str(c) for c in sorted(m) if tuple(seqs[c]) == p)
        out.append((min(m), len(p), min(nodes[p[:-1]]) if p else None, len(m), kids[p], leaves[p], saved[p], sha256(ends.encode()).hexdigest()))
    return Counter(out)


def conversations(seed=1):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 300), 150):
        for k in range(rng.choice([1, 1, 2, 4, 9, 12])):
            rows.append((c, rng.choice([k, k, k, None, 3]), rng.choice(["user", "bot", None, ""]), rng.choice(["a", "b", "é" * 5, None, ""])))
    for c in range(1000, 2300):  # copies, more than a piece of ids
        rows += [(c, 0, "system", "s"), (c, 1, "user", "u")]
    for c in (5000, 5001, 5006):  # long ones, alike for long
        rows += [(c, k, "user", f"turn {k if k < 150 else k * c}") for k in range(200)]
    rows += [(9001, 0, "u", "only its own"), (9002, 0, "u", "x" * 200_000), (None, 0, "u", "of none"), rows[3], rows[3]]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("rebuilt", "cells"), [(False, prefix_trie.CELLS), (True, 60)])
def test_trie(spark, rebuilt, cells):
    """Nulls, ties, rows given again, copies, long conversations; blocks of many rows and of few, whose paths meet."""
    rows = conversations()
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA).repartition(5)
    got = prefix_trie.conversation_trie(df, rebuilt=rebuilt, cells=cells)
    assert Counter(tuple(r) for r in got.collect()) == brute(rows, rebuilt)


@pytest.mark.parametrize("rows", [[], [(7, 0, "u", "a")], [(6, 0, "u", "a")], [(None, 0, "u", "a")], [(5, 0, "u", "a"), (6, 0, "u", "a")]])
def test_small(spark, rows):
    """No conversations; one; one that has no turns once it is rebuilt."""
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], SCHEMA)
    assert Counter(tuple(r) for r in prefix_trie.conversation_trie(df, rebuilt=True).collect()) == brute(rows, True)


def test_block_against_brute_force():
    """A block between two others: closed nodes are whole, and only the paths of its ends are open."""
    ident = lambda x: sha256(x.encode()).digest()[:16]
    rng = random.Random(2)
    seqs = sorted({b"".join(ident(rng.choice("ab")) for _ in range(rng.choice([0, 1, 3, 6]))) for _ in range(60)})
    import numpy as np

    sizes = np.ones(sum(len(s) // 16 for s in seqs), np.int64)
    out = prefix_trie.block_nodes(seqs, sizes, np.arange(len(seqs)), np.ones(len(seqs), np.int64), ["e"] * len(seqs))
    paths = {s[: 16 * d] for s in (seqs[0], seqs[-1]) for d in range(len(s) // 16 + 1)}
    assert sum(out["open"]) == len(paths)
    assert len(out["depth"]) == len({s[: 16 * d] for s in seqs for d in range(len(s) // 16 + 1)})
    assert all(k is None for k, o in zip(out["key"], out["open"], strict=True) if not o)
