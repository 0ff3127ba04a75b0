"""The stream of miss runs against the batch operator."""

import random

from recordlake.operators import coverage
from recordlake.streaming import misses


def test_stream_equals_batch(spark, tmp_path):
    """Files in shuffled order, over several runs, some again; steps that are expected only later."""
    rng = random.Random(4)
    rows = [(f"s{k}", i, rng.random() < (0.7, 0.4, 1.0, 0.0)[k % 4]) for k in range(8) for i in range(12 + k)]
    shuffled = rows + rng.sample(rows, 20)
    rng.shuffle(shuffled)
    src = str(tmp_path / "in")
    for k in range(3):
        part = shuffled[k::3]
        spark.createDataFrame(part, "series string, step int, hit boolean").coalesce(1).write.mode("append").parquet(src)
        stream = spark.readStream.schema("series string, step int, hit boolean").parquet(src)
        misses.run_miss_status(stream, 4, str(tmp_path / "out"), str(tmp_path / "ck"))
    got = {r["series"]: r for r in misses.newest_status(spark.read.schema(f"{misses.STATUS}, batch int").parquet(str(tmp_path / "out"))).collect()}
    kept = coverage.miss_runs(spark.createDataFrame(rows, "series string, step int, hit boolean"), 4).collect()
    for s, r in got.items():
        own = sorted((x["step"], x["misses"]) for x in kept if x["series"] == s)
        steps = [x for x in rows if x[0] == s]
        assert (r["steps"], r["hits"]) == (len(steps), sum(x[2] for x in steps))
        assert r["misses"] == own[-1][1] and r["stop"] == (own[-1][0] if own[-1][1] >= 4 else None)
    assert len(got) == 8


def test_a_series_is_no_call_of_python(spark, tmp_path):
    """The state is that of an aggregation; a hit that comes late splits a run, and a step that is expected later is a miss."""
    src = str(tmp_path / "in")
    stream = lambda: spark.readStream.schema("series string, step int, hit boolean").parquet(src)
    runs = [
        ([("a", 0, True), ("a", 5, False), ("b", 3, True)], {"a": (6, 1, 3, 3), "b": (4, 1, 2, 3)}),
        ([("a", 3, True), ("a", 3, True), ("a", -1, True), (None, 1, True), ("c", 0, None)], {"a": (6, 2, None, 2), "b": (4, 1, 2, 3), "c": (1, 0, None, 1)}),
        ([("b", 1, True), ("a", 7, False), ("c", 0, True)], {"a": (8, 2, 6, 3), "b": (4, 2, None, 0), "c": (1, 1, None, 0)}),
    ]
    for rows, want in runs:
        spark.createDataFrame(rows, "series string, step int, hit boolean").coalesce(1).write.mode("append").parquet(src)
        misses.run_miss_status(stream(), 3, str(tmp_path / "out"), str(tmp_path / "ck"))
        got = misses.newest_status(spark.read.schema(f"{misses.STATUS}, batch int").parquet(str(tmp_path / "out"))).collect()
        assert {r["series"]: tuple(r)[1:] for r in got} == want
    logical = misses.miss_status(stream(), 3)._jdf.queryExecution().logical().toString()
    assert "Aggregate" in logical and "Python" not in logical and "InPandas" not in logical
