"""License scans against plain sets."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordlake.llm import license_scan

from .helpers import frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, templates, containment, stride):
    out = Counter()
    for i, t in rows:
        w = WORD.findall(lower(t))
        phrases = [(k, label) for p, label in license_scan.PHRASES for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        labels, best = {x for _, x in phrases}, 0.0
        for b in range(0, len(w), stride):
            block = set(w[b : b + 2 * stride])
            for label, clause in templates:
                own = set(WORD.findall(lower(clause)))
                held = len(own & block)
                if held * 10 >= containment * 10 * len(own):
                    labels.add(label)
                    best = max(best, held / len(own))
        at = [k for k, _ in phrases]
        out[(i, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in phrases})), ",".join(sorted(labels)), 1.0 if at else best)] += 1
    return out


def texts(seed, n, size):
    rng = random.Random(seed)
    w = lambda: f"w{min(int(rng.expovariate(0.15)), size)}"  # noqa: E731  some words are everywhere
    rows = [(k, " ".join(w() for _ in range(rng.choice([0, 1, 5, 12, 40, 200])))) for k in range(n)]
    rows += [(n, None), (n + 1, ""), (n + 2, "The MIT License. the-mit\tlicense; MIT licensed, General Public LICENSE apache LicenseÉ license"), (n + 3, "mit"), (n + 4, "license mit license"), (None, "MIT License")]
    rows += [rows[3], rows[3], (n + 5, "éa MIT É license Apache  License"), (n + 6, "w1 " * 30_000 + "Licensed under CC BY-NC 4.0.")]
    return rows


@pytest.mark.parametrize(("containment", "stride", "size"), [(0.9, 40, 30), (0.6, 7, 60), (0.3, 4, 25), (1.0, 5, 40)])
def test_scan(spark, containment, stride, size):
    """Clauses of rare and of common words, at thresholds where prefixes are long and short; hot words, nulls, repeats, a long text."""
    rng = random.Random(size)
    templates = [(f"l{k % 5}", " ".join(f"w{rng.randrange(size)}" for _ in range(rng.randrange(1, stride + 1)))) for k in range(25)] + [("cc", "under cc by nc" if stride < 7 else "Licensed under CC BY-NC 4.0")]
    rows = texts(size, 60, size)
    got = license_scan.scan_licenses(frame(spark, rows).withColumn("_row", F.lit("x")), templates=templates, containment=containment, stride=stride).collect()
    assert Counter(tuple(r) for r in got) == brute(rows, templates, containment, stride)
    assert len({r["labels"] for r in got}) > 2


def test_notices_in_documents(spark):
    """Notices with words in between, around block bounds; blocks say where."""
    clause = "Redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
    rows = [(k, "lorem ipsum " * (3 * k) + clause.replace("binary", "") + " dolor" * k) for k in range(20)] + [(50, clause.replace("permitted provided that", "")), (51, "x y z")]
    got = license_scan.license_blocks(frame(spark, rows)).collect()
    assert {r["doc_id"] for r in got} == set(range(20)) and {r["label"] for r in got} == {"bsd"}
    for r in got:
        w = license_scan.words(dict(rows)[r["doc_id"]])[r["first_word"] : r["last_word"] + 1]
        own = set(license_scan.words(clause))
        assert len(own & set(w)) / len(own) == r["containment"] >= 0.9 and r["last_word"] - r["first_word"] < 80
    assert license_scan.scan_licenses(frame(spark, [])).collect() == []


def test_pieces(monkeypatch):
    """A text read in pieces has the words of the whole."""
    monkeypatch.setattr(license_scan, "PIECE", 5)
    rng = random.Random(1)
    codes = license_scan._Codes({w: k for k, w in enumerate(["a", "bb", "ccc", "é"])})
    for _ in range(200):
        text = "".join(rng.choice(["a", "bb", "ccc", "é", " ", ".", "-", "zzzzzzzzz"]) for _ in range(rng.randrange(40)))
        n, at, code = license_scan._coded(text, codes)
        w = WORD.findall(text)
        assert n == len(w) and [(k, codes[x]) for k, x in enumerate(w) if codes[x] >= 0] == list(zip(at.tolist(), code.tolist(), strict=True))


def test_clauses():
    with pytest.raises(ValueError, match="a clause has"):
        license_scan.clauses([("x", "a " * 50)])
    assert [c.need for c in license_scan.clauses([("x", "a b c d e f g h i j"), ("y", "a a b")], 0.9)] == [9, 2]
    assert np.array_equal(license_scan._phrase_places(np.array([0, 1, 3, 4, 5]), np.array([1, 2, 1, 1, 2]), [1, 2]), [0, 4])
