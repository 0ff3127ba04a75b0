"""Exact dedup, n-gram join, substring dedup and decontamination against brute force."""

import hashlib
import os
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordlake.llm import decontaminate, exact_dedup, fm_index, ngram_join, substring_dedup
from recordlake.llm.common import stored
from recordlake.llm.graph import components

from .helpers import WORD, corpus, frame, table, words


@pytest.mark.parametrize("options", [{}, {"bucket_keys": 4}, {"bucket_keys": 3, "top_bits": 2}, {"bucket_keys": 8, "hash_bits": 4}])
def test_exact_dedup(spark, tmp_path, options):
    """One bucket, many, pages of many slots, and keys that collide so that chains hold several texts."""
    rows = corpus()
    groups = defaultdict(list)
    for i, t in rows:
        groups[t or ""].append(i)
    want = Counter()
    for t, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        for i in ids:
            want[(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest())] += 1
    got = exact_dedup.exact_dedup(table(spark, tmp_path, rows), **options).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got) == want
    assert (len({r["bucket"] for r in got}) > 4) == ("bucket_keys" in options)
    assert (max(r["chain"] for r in got) > 1) == ("hash_bits" in options)


def test_drop_copies_keeps_columns(spark, tmp_path):
    docs = table(spark, tmp_path, corpus())
    got = exact_dedup.drop_copies(docs)
    assert got.columns == docs.columns
    texts = [r["text"] or "" for r in got.collect()]
    assert len(texts) == len(set(texts)) == len({t or "" for _, t in corpus()})


def brute_directory(keys, most, least):
    """(bucket of each key) by splitting full buckets by their next bit, and all down to the depth of pages."""
    out, open_ = {}, [(0, 0, list(keys))]
    while open_:
        prefix, local, own = open_.pop()
        if len(own) <= most and local >= least:
            out |= dict.fromkeys(own, (1 << local) | prefix)
        else:
            bit = lambda k, local=local: (k >> (63 - local)) & 1
            open_ += [(2 * prefix + b, local + 1, [k for k in own if bit(k) == b]) for b in (0, 1)]
    return out


def entries(spark, keys):
    return spark.createDataFrame([(k, b"x", 1, 1) for k in keys], "h long, sha binary, keep_id long, group_size long")


@pytest.mark.parametrize(("most", "bits"), [(5, 0), (5, 3), (1, 2), (400, 0)])
def test_directory_grows(spark, most, bits):
    """Buckets are those of plain splitting, however deep a crowd of keys goes; each key is found in its bucket."""
    rng = np.random.default_rng(4)
    keys = [int(x) for x in rng.integers(-(1 << 63), (1 << 63) - 1, 300)] + [int(x) for x in rng.integers(0, 1 << 24, 60)]  # a crowd under one prefix
    index = exact_dedup.Index(entries(spark, keys), most, bits)
    got = {r["h"]: r["bucket"] for r in index.look_up(spark.createDataFrame([(k,) for k in keys], "h long")).collect()}
    assert {k % (1 << 64): b for k, b in got.items()} == brute_directory([k % (1 << 64) for k in keys], most, bits)
    assert max(b.bit_length() for b in got.values()) - 1 >= (40 if most < 6 else 0)
    assert index.look_up(spark.createDataFrame([(12345678901234,)], "h long")).count() == 0


def test_a_wrong_page_loses_its_keys(spark, tmp_path, monkeypatch):
    """A page whose directory leads elsewhere: rows of its keys are not found, and no others are lost."""
    docs = table(spark, tmp_path, corpus())
    build = exact_dedup.pages
    want = exact_dedup.exact_dedup(docs, bucket_keys=4, top_bits=3).collect()

    def wrong(*args):
        out = build(*args)
        return out.withColumn("starts", F.when(F.col("page_no") == 5, F.transform("starts", lambda s: s.bitwiseXOR(F.lit(1 << 62)))).otherwise(F.col("starts")))

    monkeypatch.setattr(exact_dedup, "pages", wrong)
    got = exact_dedup.exact_dedup(docs, bucket_keys=4, top_bits=3).collect()
    page = lambda r: (r["bucket"] >> (r["bucket"].bit_length() - 4)) - 8  # noqa: E731  the first three bits after the leading one
    assert any(page(r) == 5 for r in want) and Counter(got) == Counter(r for r in want if page(r) != 5)


def test_pages_are_read_where_they_lie(spark, tmp_path, monkeypatch):
    """The index is shuffled once, by its owners; a page that many rows ask for is there several times."""
    monkeypatch.setattr(exact_dedup, "HOT_ROWS", 50)
    rows = [(k, "the same" if k % 2 else f"text {k}") for k in range(400)]
    docs = table(spark, tmp_path, rows)
    merged = docs.groupBy(F.xxhash64("text").alias("h")).agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")).withColumn("sha", F.lit(b"x"))
    index = exact_dedup.Index(merged, 4, 2)
    assert index.table.agg(F.max("turn")).first()[0] >= 3 and index.hot.count() >= 1
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = index.look_up(docs.select("doc_id", F.xxhash64("text").alias("h")))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    assert Counter((r["keep_id"], r["group_size"]) for r in exact_dedup.exact_dedup(docs, bucket_keys=4, top_bits=2).collect())[(399, 200)] == 200


def brute_links(rows):
    sets = []
    for _, t in rows:
        w = WORD.findall(t or "")
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
    links = [0] * len(rows)
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both * 10 >= 8 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return links, [find(i) for i in range(len(rows))]


def test_ngram_join(spark, tmp_path):
    rows = corpus()
    got = ngram_join.ngram_join(table(spark, tmp_path, rows), ngram_join.Forest(block=5)).collect()
    links, roots = brute_links(rows)
    members = defaultdict(list)
    for (i, _), r in zip(rows, roots, strict=True):
        members[r].append(i)
    ids = {r: min((i for i in m if i is not None), default=None) for r, m in members.items()}
    want = Counter((i, ids[r], len(members[r]), n) for (i, _), r, n in zip(rows, roots, links, strict=True))
    assert Counter((r["doc_id"], r["class_id"], r["class_size"], r["n_links"]) for r in got) == want


def test_drop_near_copies(spark, tmp_path):
    rows = corpus()
    docs = table(spark, tmp_path, rows)
    got = ngram_join.drop_near_copies(docs)
    _, roots = brute_links(rows)
    assert got.columns == docs.columns
    assert got.count() == len(set(roots))


def test_common_prefix():
    pack = lambda v: [sum(x << (12 * (4 - k)) for k, x in enumerate(v[i : i + 5])) for i in (0, 5)]
    a, b = list(range(10)), [*range(7), 99, 8, 9]
    assert ngram_join.common_prefix(np.array([pack(a), pack(a)]), np.array([pack(b), pack(a)])).tolist() == [7, 10]


def near_pairs(rng, n, shared, own):
    """Texts whose word 5-grams have a Jaccard similarity of about (shared - 4) / (shared + 2 * own)."""
    rows = []
    for k in range(n):
        body = words(rng, shared, 50000)
        for side in (0, 1):
            rows.append((2 * k + side, " ".join([*body, *(f"x{k}.{side}.{j}" for j in range(own))])))
    return rows


@pytest.mark.parametrize(("own", "shortens"), [(10, True), (0, False)])
def test_forest_shortens_prefixes(spark, tmp_path, monkeypatch, own, shortens):
    """Pairs just above the threshold make prefixes shorter; copies do not. Recall against brute force."""
    rows = near_pairs(random.Random(1), 150, 90, own)
    if not own:
        rows = [(i, t + f" end{i % 2}") for i, t in rows]
    seen = []
    linked = ngram_join._linked
    monkeypatch.setattr(ngram_join, "_linked", lambda *a: seen.append(linked(*a)) or seen[-1])
    p = ngram_join.Forest(trees=8, recall=0.98)
    got = {r["doc_id"]: r["n_links"] for r in ngram_join.ngram_join(table(spark, tmp_path, rows), p).collect()}
    want = dict(zip((i for i, _ in rows), brute_links(rows)[0], strict=True))
    assert sum(got.values()) >= 0.95 * sum(want.values()) > 0 and all(got[i] <= want[i] for i in want)
    assert (seen[0][1] < p.longest - p.step) == shortens


def test_crowded_prefixes_lose_no_links(spark, tmp_path):
    """Four hundred texts share half of their words, so that prefixes are crowded with texts that are not alike; pairs among them are just above the threshold."""
    rng = random.Random(9)
    common = words(rng, 60, 50000)
    rows = []
    for k in range(400):
        rows.append((k, " ".join([*common, *words(rng, 60, 50000)])))
    for k in range(40):  # one word in the middle of what is their own is another: 115 of 120 grams alike
        w = rows[k][1].split()
        w[80 + k % 30] = "other"
        rows.append((1000 + k, " ".join(w)))
        w = rows[k + 50][1].split()
        w[70], w[85] = "other", "others"
        rows.append((2000 + k, " ".join(w)))
    got = {r["doc_id"]: r["n_links"] for r in ngram_join.ngram_join(table(spark, tmp_path, rows)).collect()}
    want = dict(zip((i for i, _ in rows), brute_links(rows)[0], strict=True))
    assert got == want and sum(want.values()) == 160


def test_links_of_null_ids(spark, tmp_path):
    """Many rows without an id: each meets what its own text is like, not every other."""
    rng = random.Random(3)
    bodies = [words(rng, 60, 3000) for _ in range(40)]
    rows = [(None, " ".join(b)) for b in bodies] + [(None, " ".join([*b, "tail"])) for b in bodies[:10]] + [(None, " ".join(bodies[0]))] * 5
    got = Counter(r["n_links"] for r in ngram_join.ngram_join(table(spark, tmp_path, rows)).collect())
    assert got == Counter(brute_links(rows)[0])
    plan = ngram_join._links(table(spark, tmp_path, rows), ngram_join.Forest(), "doc_id", "text")[0]._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def brute_repeats(rows, size):
    seen = Counter()
    for _, t in rows:
        w = WORD.findall(t or "")
        seen.update(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    out = Counter()
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if seen[tuple(w[k : k + size])] > 1:
                gone[k : k + size] = [True] * size
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[(i, len(w), sum(gone), kept)] += 1
    return out


@pytest.mark.parametrize(("shard_words", "hot_words"), [(1_000_000, 1 << 18), (300, 1 << 18), (1_000_000, 100)])
def test_substring_dedup(spark, tmp_path, monkeypatch, shard_words, hot_words):
    """One shard, many, and keys so full that their windows are dealt one by one."""
    monkeypatch.setattr(substring_dedup.repeated_passages, "__defaults__", ("doc_id", "text", 35, 8, shard_words, hot_words))
    rows = corpus(3)
    got = substring_dedup.cut_repeats(table(spark, tmp_path, rows)).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept_text"]) for r in got) == brute_repeats(rows, 35)
    for r in got:
        assert r["kept_sha256"] == hashlib.sha256(r["kept_text"].encode()).hexdigest()
        assert sum(s["to"] - s["from"] for s in r["spans"] or []) == r["n_removed"]


def test_repeats_come_from_the_index(spark, tmp_path, monkeypatch):
    """Without what backward search finds nothing goes, copies neither."""
    rows = [(1, " ".join(f"a{k}" for k in range(50))), (2, " ".join(f"a{k}" for k in range(50))), (3, "x " * 80)]
    docs = table(spark, tmp_path, rows)
    assert sum(r["n_removed"] for r in substring_dedup.cut_repeats(docs).collect()) == 180
    search = substring_dedup.search_shard
    assert search(pa.table({"key": [1], "content": [1], "copies": [1], "text": [rows[0][1]]}), 35).num_rows == 0
    assert search(pa.table({"key": [1], "content": [1], "copies": [2], "text": [rows[0][1]]}), 35).to_pylist() == [{"key": 1, "content": 1, "first": 0, "last": 15}]


def test_rows_given_again_and_again(spark):
    """What repeated rows carry does not grow with their number."""
    t = " ".join(f"a{k}" for k in range(90))
    rows = spark.range(3000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(t).alias("text"))
    spans = substring_dedup.repeated_passages(rows).collect()
    assert len(spans) == 1 and len(spans[0]["spans"]) < 30
    got = substring_dedup.cut_repeats(rows).groupBy("n_words", "n_removed").count().collect()
    assert [tuple(r) for r in got] == [(90, 90, 3000)]


def _shuffled(spark) -> set[str]:
    return {f for _, _, files in os.walk(spark.sparkContext.getConf().get("spark.local.dir")) for f in files if re.fullmatch(r"shuffle_.*\.data", f)}


@pytest.mark.parametrize("hot_words", [1 << 18, 100])
def test_shuffle_files_go_with_their_step(spark, tmp_path, hot_words):
    """When the passages are found, no step before has left shuffle files, and the session is set as it was."""
    docs = table(spark, tmp_path, corpus(4))
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = _shuffled(spark), spark.conf.get(name)
    substring_dedup.repeated_passages(docs, hot_words=hot_words)
    for _ in range(50):  # files are removed in the background
        if not (left := _shuffled(spark) - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(name) == was


def test_texts_are_shuffled_once_to_be_quoted(spark, tmp_path):
    """Rows given again are quoted once, null ids too; neither the join nor the merging of copies shuffles texts again."""
    t = " ".join(f"a{k}" for k in range(90))
    rows = [(None, t)] * 20 + [(1, t)] * 20 + [(2, t)] + [(3, None)]
    texts = table(spark, tmp_path, rows).select(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("th"), "text")
    wanted = texts.filter("id is null or id = 1").distinct().select(F.coalesce("id", F.lit(7)).alias("key"), F.lit(5).cast("long").alias("content"), F.lit(2).cast("long").alias("copies"), "id", "th", F.lit(3).alias("start"), F.lit(4).alias("length"))
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        quoted = substring_dedup._quoted(texts, stored(wanted, "wanted"))
        assert quoted._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    assert sorted((r["key"], r["id"] or 0, r["text"]) for r in quoted.collect()) == [(1, 1, "a3 a4 a5 a6"), (7, 0, "a3 a4 a5 a6")]


def test_bits():
    rng = np.random.default_rng(3)
    for bit in (rng.random(1000) < 0.5, np.repeat(rng.random(40) < 0.5, 500), np.zeros(0, bool), np.ones(64, bool)):
        b = fm_index.Bits(bit)
        assert (b.ones(np.arange(len(bit) + 1)) == np.concatenate([[0], np.cumsum(bit)])).all()
    assert fm_index.Bits(np.repeat(rng.random(400) < 0.5, 5000)).nbytes() < 2_000_000 / 8


def test_weights_of_runs():
    codes, bounds = np.array([1, 2, 3, 1, 2, 4]), np.array([0, 3, 6])
    index = fm_index.FmIndex(codes, bounds, weights=np.array([3, 1]))
    assert fm_index.repeated_windows(index, codes, bounds, 2, 2).tolist() == [True, True, False, True, False, False]
    assert fm_index.repeated_windows(index, codes, bounds, 2, 4).tolist() == [True, False, False, True, False, False]


def test_fm_index():
    rng = np.random.default_rng(1)
    for _ in range(30):
        runs = [rng.integers(1, 4, rng.integers(3, 30)) for _ in range(rng.integers(1, 9))]
        codes, bounds = np.concatenate(runs), np.concatenate([[0], np.cumsum([len(r) for r in runs])])
        k = int(rng.integers(2, 8))
        seen = Counter(tuple(r[i : i + k]) for r in runs for i in range(len(r) - k + 1))
        want = np.concatenate([[i + k <= len(r) and seen[tuple(r[i : i + k])] > 1 for i in range(len(r))] for r in runs])
        assert (fm_index.repeated_windows(fm_index.FmIndex(codes, bounds), codes, bounds, k, 2) == want).all()


def test_segments_in_parts(monkeypatch):
    h = np.random.default_rng(2).integers(0, 1 << 62, 700).astype(np.uint64)
    row = np.zeros(700, np.int64)
    first, length, key = substring_dedup.segments(h, row, 35, 8)
    covered = [x for f, n in zip(first, length, strict=True) for x in range(f, f + n - 34)]
    assert covered == list(range(700 - 34))
    monkeypatch.setattr(substring_dedup, "_PLACE", 8)
    first2, length2, key2 = substring_dedup.segments(h, row, 35, 8)
    windows = lambda a, b, c: {x: k for f, n, k in zip(a, b, c, strict=True) for x in range(f, f + n - 34)}
    assert windows(first, length, key).keys() == windows(first2, length2, key2).keys()


def test_components(spark):
    edges = [(1, 2), (3, 2), (5, 4), (6, 7), (7, 8), (8, 9), (9, 10), (3, 3)]
    got = {r["v"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 6, 8: 6, 9: 6, 10: 6}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def bench_rows():
    return [(1, "Alpha beta gamma delta epsilon zeta eta theta. Iota kappa lambda mu nu xi omicron pi rho."), (2, "q" + " ".join(f"item{k}" for k in range(70))), (3, None), (4, ""), (5, "The of and."), (1, "Second text under the same id: sigma tau upsilon phi chi psi omega digamma stigma.")]


def test_decontaminate(spark, tmp_path):
    rows = corpus(5)
    a, b = bench_rows()[0][1], bench_rows()[1][1]
    changed = a.replace("gamma", "gimel").replace("zeta", "zed").replace("mu", "mem")
    rows += [(200, rows[3][1] + " " + a + " " + rows[4][1]), (201, a.upper()), (202, rows[3][1] + " " + changed), (203, rows[2][1] + " " + b), (204, b[: len(b) // 4]), (205, "alpha only theta pi"), (203, rows[2][1] + " " + b)]
    rows.append((206, rows[3][1] + " sigma tau upsilon phi chi psi omega digamma stigma second text under the same id"))
    items = spark.createDataFrame(bench_rows(), "item_id long, text string")
    docs = table(spark, tmp_path, rows)
    for block in (2048, 2):
        got = decontaminate.contaminated(docs, items, decontaminate.Search(items=block)).collect()
        pairs = Counter((r["doc_id"], r["item_id"]) for r in got)
        pairs.pop((206, 1), None)  # its halves are swapped: either answer is right
        assert pairs == Counter({(200, 1): 1, (201, 1): 1, (202, 1): 1, (203, 2): 2})
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns and {200, 201, 202, 203}.isdisjoint({r["doc_id"] for r in left.collect()})


def test_decontaminate_many_items(spark, tmp_path):
    """Recall does not fall with the number of items, or with what stands around them."""
    rng = np.random.default_rng(7)
    take = lambda n, low, high: " ".join(f"w{k}" for k in rng.integers(low, high, n))
    items = [(k, take(30, 0, 6000)) for k in range(1500)]
    items += [(1500 + k, take(32, 6000, 6040)) for k in range(3)]  # common words
    planted = items[:1500:7] + items[1500:]
    rows = [(k, f"{take(70, 0, 6000)} {t} {take(70, 0, 6000)}") for k, t in planted]
    rows += [(2000 + k, take(180, 0, 6000)) for k in range(50)] + [(3000 + k, take(300, 6000, 6040)) for k in range(60)]
    got = decontaminate.contaminated(table(spark, tmp_path, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert Counter((r["doc_id"], r["item_id"]) for r in got if r["doc_id"] < 3000) == Counter({(k, k): 1 for k, _ in planted})


def test_decontaminate_paraphrases(spark, tmp_path):
    """Recall of items told in other words: some are replaced, left out or put in, as far as an item still counts as told."""
    rng = random.Random(5)
    items = [(k, " ".join(words(rng, 40, 4000))) for k in range(300)]

    def told(text):
        out = []
        for x in text.split():
            u = rng.random()
            out += [f"syn{rng.randrange(500)}"] if u < 0.08 else [] if u < 0.14 else [x, f"more{rng.randrange(500)}"] if u < 0.22 else [x]
        return " ".join(out)

    rows, counts = [], set()
    for k, t in items[::2]:
        text = f"{' '.join(words(rng, 50, 4000))} {told(t)} {' '.join(words(rng, 50, 4000))}"
        rows.append((k, text))
        if decontaminate.common_length(t.split(), text.split()) >= 0.8 * 40:
            counts.add(k)
    got = decontaminate.contaminated(table(spark, tmp_path, rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    assert len(counts) > 100 and len({(k, k) for k in counts} & found) >= 0.97 * len(counts)
    assert all(a == b for a, b in found)


def test_other_words_of_the_corpus(spark, tmp_path):
    """Items told with synonyms for all their rare words: plain weights see next to nothing of them, a space with a dimension for each topic does."""
    rng = random.Random(8)
    common = [f"c{k}" for k in range(12)]
    topic = lambda k, side: [f"{side}{k}x{j}" for j in range(8)]
    told = lambda rare: " ".join(x for j, r in enumerate(rare) for x in (*(common[(j * 4 + i) % 12] for i in range(4)), r))
    items, planted, rows = [], [], []
    for k in range(60):
        at = rng.sample(range(8), 6)
        items.append((k, told([topic(k % 12, "a")[j] for j in at])))
        planted.append((k, told([topic(k % 12, "b")[j] for j in at])))
    for n in range(1500):  # where one word of a pair stands, so may the other
        k = n % 12
        some = rng.sample(topic(k, "a") + topic(k, "b"), 8)
        rows.append((10_000 + n, " ".join(rng.sample(some + common * 4, 56))))
    docs = table(spark, tmp_path, rows + planted)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = lambda **o: {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, benchmark, decontaminate.Search(**o)).collect() if r["doc_id"] < 10_000}
    own = {(k, k) for k in range(60)}
    lcs = {(i, k) for i, t in planted for k, x in items if decontaminate.common_length(x.split(), t.split()) >= 0.8 * len(x.split())}
    got = found(rank=12)
    assert own <= lcs and got <= lcs and len(own & got) >= 0.9 * len(own)
    assert len(own & found(sample=0)) <= 0.1 * len(own)


def test_decontaminate_by_brute_force(spark, tmp_path):
    """The subsequence of every item with every text of a window decides alike: nothing else is found, and hardly any missed."""
    rng = random.Random(9)
    items = [(k, " ".join(words(rng, 24, 300))) for k in range(80)]
    rows = [(k, " ".join(words(rng, 60, 300))) for k in range(300)]
    for n in range(600):
        _, t = items[rng.randrange(80)]
        t = [x if rng.random() < rng.choice([0.6, 0.75, 0.85, 1.0]) else f"w{rng.randrange(300)}" for x in t.split()]
        rows.append((1000 + n, " ".join(words(rng, 18, 300) + t + words(rng, 18, 300))))
    want = set()
    for i, t in rows:
        t = t.split()
        for k, x in items:
            x = x.split()
            share = decontaminate.common_length(x, t) / len(x)
            if share >= 0.8:  # an item of one sentence: its answer is itself
                want.add((i, k))
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(table(spark, tmp_path, rows), spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert len(want) > 200 and got <= want and len(got) >= 0.97 * len(want), (len(want), len(got), len(got - want))


def test_spaces_of_the_corpus_miss_nothing(spark, tmp_path):
    """Latent spaces of sampled windows find what complete spaces find, also where they hold next to nothing of a passage."""
    rng = random.Random(6)
    items = spark.createDataFrame([(k, " ".join(words(rng, 30, 900))) for k in range(60)], "item_id long, text string")
    rows = [(i, t) for i, t in corpus(6, 80)] + [(5000 + r["item_id"], "before " + r["text"] + " after") for r in items.collect()[::3]]
    docs = table(spark, tmp_path, rows)
    pairs = lambda **o: Counter((r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, items, decontaminate.Search(**o)).collect())
    want = pairs(sample=0)
    assert sum(want.values()) >= 20 and want == pairs() == pairs(rank=24, weight=2.0) == pairs(rank=24, held=0.2)


def test_drop_contaminated_keys(spark, tmp_path):
    """A contaminated text under a null or repeated id takes no other text with it."""
    a = bench_rows()[0][1]
    clean = [(None, "clean under a null id"), (None, "clean under a null id"), (None, None), (7, "clean under seven"), (7, ""), (8, "clean")]
    docs = table(spark, tmp_path, [*clean, (None, "before " + a), (7, a + " after"), (7, a + " after"), (9, a)])
    left = decontaminate.drop_contaminated(docs, spark.createDataFrame(bench_rows(), "item_id long, text string"))
    assert left.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in left.collect()) == Counter(clean)


def test_common_length():
    assert decontaminate.common_length(list("abcbdab"), list("bdcaba")) == 4
    assert decontaminate.common_length([], list("ab")) == 0


def test_randomised_svd(spark):
    rng = np.random.default_rng(0)
    m = rng.standard_normal((40, 6)) @ rng.standard_normal((6, 30))
    rows = spark.createDataFrame([(np.arange(30, dtype=np.int32).tobytes(), r.astype(np.float32).tobytes()) for r in m], "features binary, values binary")
    v, s = decontaminate.randomised_svd(rows, 30, 6, 4, 2, 1)
    assert np.allclose(s, np.linalg.svd(m)[1][:6], rtol=1e-3)
    assert np.allclose(m @ v @ v.T, m, atol=1e-2)


def test_empty_tables(spark):
    docs = frame(spark, [])
    items = spark.createDataFrame([], "item_id long, text string")
    assert exact_dedup.exact_dedup(docs).count() == 0
    assert ngram_join.ngram_join(docs).count() == 0
    assert substring_dedup.cut_repeats(docs).count() == 0
    assert decontaminate.contaminated(docs, items).count() == 0
    assert decontaminate.contaminated(frame(spark, [(1, "a b")]), items).count() == 0
    assert decontaminate.contaminated(docs, spark.createDataFrame(bench_rows(), "item_id long, text string")).count() == 0
