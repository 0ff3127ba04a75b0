"""License scans: an exact set-similarity join of text blocks with the clauses of license templates.

A block matches a clause if it holds so large a part of the clause's words. Words are ordered by how many blocks hold
them, rare ones first. A match shares a word of the first few of both in this order, which is what is joined; how many
words a block has and where the shared word stands in both rule out most pairs before the rest are compared.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, stored

#: Phrases and the labels that they stand for.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Label and clause; words of public license notices.
TEMPLATES = (
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction"),
    ("mit", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software"),
    ("mit", "Released under the MIT License"),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
)
#: Words between the starts of blocks. A block has twice as many, so that each run of so many words lies in a block whole.
STRIDE = 40
#: Part of a clause's words that a block must hold.
CONTAINMENT = 0.9
#: Characters of a text that are split into words at a time.
PIECE = 1 << 20
#: Entries of the clauses' index that are broadcast; more are joined by shuffle.
FEW_ENTRIES = 100_000
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_GAP = re.compile(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]")


def words(text: str) -> list[str]:
    """Words of a text with A to Z in lower case."""
    return _WORD.findall(pc.ascii_lower(pa.scalar(text)).as_py())


@dataclass(frozen=True)
class Clause:
    label: str
    words: tuple[str, ...]
    need: int  # words that a block must hold


def clauses(templates=TEMPLATES, containment: float = CONTAINMENT, stride: int = STRIDE) -> list[Clause]:
    """The distinct words of each clause, and how many of them a match has. Clauses of more than stride words are an error."""
    out = []
    for label, text in templates:
        w = words(text)
        if not w or len(w) > stride:
            raise ValueError(f"a clause has 1 to {stride} words: {text!r}")
        own = tuple(dict.fromkeys(w))
        out.append(Clause(label, own, max(1, math.ceil(Fraction(str(containment)) * len(own)))))
    return out


class _Codes(dict):
    def __missing__(self, word: str) -> int:
        return -1


def _coded(text: str, codes: _Codes) -> tuple[int, np.ndarray, np.ndarray]:
    """(words of a text, the places and codes of those that are in codes), piece by piece."""
    n, at, where, what = 0, 0, [], []
    while at < len(text):
        gap = _GAP.search(text, at + PIECE) if at + PIECE < len(text) else None
        to = gap.start() if gap else len(text)
        found = np.fromiter(map(codes.__getitem__, _WORD.findall(text, at, to)), np.int32)
        hit = np.flatnonzero(found >= 0)
        where.append(n + hit)
        what.append(found[hit])
        n, at = n + len(found), to
    if not where:
        return 0, np.empty(0, np.int64), np.empty(0, np.int32)
    return n, np.concatenate(where), np.concatenate(what)


def _phrase_places(at: np.ndarray, code: np.ndarray, phrase: list[int]) -> np.ndarray:
    """Places where the words of a phrase stand one after another."""
    k = len(phrase)
    if len(at) < k:
        return at[:0]
    m = len(at) - k + 1
    ok = at[k - 1 :] == at[:m] + k - 1
    for j, c in enumerate(phrase):
        ok = ok & (code[j : j + m] == c)
    return at[:m][ok]


def _block_sets(at: np.ndarray, code: np.ndarray, size: int, stride: int, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(block, number of its words, words in blocks one after another) of the blocks that hold at least so many different words."""
    block = at // stride
    key = np.unique(np.concatenate([block, block[block > 0] - 1]) * size + np.concatenate([code, code[block > 0]]))
    of, word = key // size, key % size
    start = np.flatnonzero(np.diff(of, prepend=-1))
    n = np.diff(np.append(start, len(of)))
    keep = n >= least
    return of[start][keep], n[keep], word[np.repeat(keep, n)]


def read_blocks(docs: DataFrame, wanted: list[Clause], row: str, text_col: str, keep: tuple[str, ...] = (), phrases=PHRASES, stride: int = STRIDE) -> tuple[DataFrame, list[str]]:
    """(row, keep, n_words, n_base, first_word, last_word, base_labels, blocks of each document; the words that codes in blocks stand for).

    blocks: block and codes of its words that any clause has; only those that are long enough for a clause.
    """
    vocabulary = list(dict.fromkeys([w for c in wanted for w in c.words] + [w for p, _ in phrases for w in words(p)]))
    codes = _Codes({w: k for k, w in enumerate(vocabulary)})
    coded = [([codes[w] for w in words(p)], label) for p, label in phrases]
    of_clauses, least = len({w for c in wanted for w in c.words}), min((c.need for c in wanted), default=1)
    size = len(vocabulary)

    def found(batches):
        for batch in batches:
            out: dict[str, list] = {c: [] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels")}
            per_doc, sizes, flat, blocks = [0], [], [], []
            for text in batch.column(batch.num_columns - 1):
                n, at, code = _coded(pc.ascii_lower(text).as_py() or "", codes)
                places = [(_phrase_places(at, code, p), label) for p, label in coded]
                every = np.concatenate([p for p, _ in places]) if places else at[:0]
                out["n_words"].append(n)
                out["n_base"].append(len(every))
                out["first_word"].append(int(every.min()) if len(every) else None)
                out["last_word"].append(int(every.max()) if len(every) else None)
                out["base_labels"].append(",".join(sorted({label for p, label in places if len(p)})))
                own = code < of_clauses
                b, k, w = _block_sets(at[own], code[own], size, stride, least)
                blocks.append(b), sizes.append(k), flat.append(w)
                per_doc.append(per_doc[-1] + len(b))
            ints = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
            inner = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(np.concatenate(sizes))]) if sizes else [0], pa.int32()), ints(flat, pa.int32()))
            lists = pa.ListArray.from_arrays(pa.array(per_doc, pa.int32()), pa.StructArray.from_arrays([ints(blocks, pa.int64()), inner], ["block", "codes"]))
            counts = [pa.array(out[c], pa.int64()) for c in ("n_words", "n_base", "first_word", "last_word")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *counts, pa.array(out["base_labels"], pa.string()), lists], [row, *keep, "n_words", "n_base", "first_word", "last_word", "base_labels", "blocks"])

    kinds = dict(docs.dtypes)
    head = f"`{row}` long, " + "".join(f"`{c}` {kinds[c]}, " for c in keep)
    kind = head + "n_words long, n_base long, first_word long, last_word long, base_labels string, blocks array<struct<block: bigint, codes: array<int>>>"
    return docs.select(row, *[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(found, kind), vocabulary


def contained(blocks: DataFrame, wanted: list[Clause], vocabulary: list[str], row: str) -> DataFrame:
    """row, block, clause, overlap of each block that holds the needed words of a clause; clause is its place in wanted.

    blocks: row, block, codes. Words are counted over all blocks; the counts are as many as the clauses' words.
    """
    spark = blocks.sparkSession
    seen = {r["code"]: r["n"] for r in blocks.select(F.explode("codes").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = sorted(range(len(vocabulary)), key=lambda k: (seen.get(k, 0), vocabulary[k]))
    rank = {vocabulary[k]: r for r, k in enumerate(order)}
    ranks = F.array(*[F.lit(rank[w]) for w in vocabulary])
    sets = blocks.select(row, "block", F.array_sort(F.transform("codes", lambda c: F.get(ranks, c))).alias("words")).withColumn("m", F.size("words"))
    entries = []
    for k, c in enumerate(wanted):
        own = sorted(rank[w] for w in c.words)
        entries += [(w, k, i, len(own), c.need, own) for i, w in enumerate(own[: len(own) - c.need + 1])]  # the prefix
    index = spark.createDataFrame(entries, "word int, clause int, i int, n int, need int, own array<int>")
    index = F.broadcast(index) if len(entries) <= FEW_ENTRIES else index
    least = min((c.need for c in wanted), default=1)
    prefix = F.slice("words", F.lit(1), F.greatest(F.col("m") - (least - 1), F.lit(0)))
    pairs = sets.select(row, "block", "words", "m", F.posexplode(prefix).alias("j", "word")).join(index, "word")
    rest = F.least(F.col("n") - F.col("i"), F.col("m") - F.col("j"))  # the shared word and what can follow in both
    pairs = pairs.filter((F.col("m") >= F.col("need")) & (F.col("j") <= F.col("m") - F.col("need")) & (rest >= F.col("need")))
    overlap = F.size(F.array_intersect("words", "own"))
    met = pairs.withColumn("overlap", overlap).filter(F.col("overlap") >= F.col("need"))
    return met.groupBy(row, "block", "clause").agg(F.first("overlap").alias("overlap"))


def license_blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, containment: float = CONTAINMENT, stride: int = STRIDE) -> DataFrame:
    """doc_id, first_word, last_word (at most), label, clause, containment of each block of each document that matches a clause."""
    wanted = clauses(templates, containment, stride)
    row = fresh(docs, "_row")
    read, vocabulary = read_blocks(docs.withColumn(row, F.monotonically_increasing_id()), wanted, row, text_col, (id_col,), stride=stride)
    read = stored(read, "license-documents")
    met = contained(read.select(row, F.inline("blocks")), wanted, vocabulary, row).join(read.select(row, F.col(f"`{id_col}`").alias("doc_id"), "n_words"), row)
    label, n = F.array(*[F.lit(c.label) for c in wanted]), F.array(*[F.lit(len(c.words)) for c in wanted])
    first = F.col("block") * stride
    return met.select("doc_id", first.alias("first_word"), (F.least(first + 2 * stride, "n_words") - 1).alias("last_word"), F.get(label, "clause").alias("label"), "clause", (F.col("overlap") / F.get(n, "clause")).alias("containment"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES, containment: float = CONTAINMENT, stride: int = STRIDE, phrases=PHRASES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of each document.

    n_base, first_word, last_word and base_labels tell where phrases stand; labels are those of the phrases and of the
    clauses that a block of the document matches; score is the largest part of a clause that a matching block holds, 1 if
    there is a phrase, else 0. A null text is empty; very long texts are read in pieces that end between words; rows that
    repeat are scanned each; ids may be null; other columns are not read, whatever their names. No rows give no rows.
    """
    wanted = clauses(templates, containment, stride)
    row = fresh(docs, "_row")
    read, vocabulary = read_blocks(docs.withColumn(row, F.monotonically_increasing_id()), wanted, row, text_col, (id_col,), phrases, stride)
    read = stored(read, "license-documents")
    met = contained(read.select(row, F.inline("blocks")), wanted, vocabulary, row)
    label, n = F.array(*[F.lit(c.label) for c in wanted]), F.array(*[F.lit(len(c.words)) for c in wanted])
    found = met.groupBy(row).agg(F.collect_set(F.get(label, "clause")).alias("own"), F.max(F.col("overlap") / F.get(n, "clause")).alias("best"))
    out = read.drop("blocks").join(found, row, "left")
    base = F.when(F.col("base_labels") == "", F.array().cast("array<string>")).otherwise(F.split("base_labels", ","))
    labels = F.array_join(F.array_sort(F.array_union(base, F.coalesce("own", F.array().cast("array<string>")))), ",")
    score = F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0)))
    return out.select(F.col(f"`{id_col}`").alias("doc_id"), "n_words", "n_base", "first_word", "last_word", "base_labels", labels.alias("labels"), score.alias("score"))
