import io
import zipfile
from collections import Counter
from datetime import date

import pytest
from pyspark.sql import functions as F

from recordlake.functions import kinds, pic
from recordlake.operators import coverage, layout, ledger, parse
from recordlake.operators.parse import Field
from recordlake.plans import jobs
from recordlake.sources import archives, commits, layouts, lines
from recordlake.sources.scratch import scratch
from recordlake.streaming.ingest import ingest, ingest_versions

H = [Field("Record Type", 1, "X"), Field("File Name", 4, "X(4)"), Field("Filler", 2), Field("Count", 3, "9(3)")]


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_fixed_width_edges(spark):
    df = spark.createDataFrame([("H\tab XX012",), ("H",), ("",), ("Zabcdxx999",), ("Habcdxx12aEXTRA",)], "text_content string")
    got = parse.fixed_width(df, H, "H", typed_values=True)
    assert got.columns == ["Record Type", "File Name", "Filler_2", "Count"]
    assert sorted(rows_of(got), key=str) == sorted([("H", "ab", "XX", 12), ("H", "", "", None), ("H", "abcd", "xx", None)], key=str)
    assert parse.fixed_width(df, H).count() == 5


def test_prefix_filter_reaches_the_scan(spark, tmp_path):
    path = f"{tmp_path}/lines"
    spark.createDataFrame([("Habcd",)], "text_content string").write.parquet(path)
    plan = parse.fixed_width(spark.read.parquet(path), H, "H")._jdf.queryExecution().toString()
    assert "StringStartsWith(text_content,H)" in plan


def test_delimited_edges(spark):
    fields = [Field("Record Type"), Field("a"), Field("a")]
    df = spark.createDataFrame([("LL|1|2|3",), ("LL|1",), ("L|x|y",), ("LL| 1 |",)], "text_content string")
    got = parse.delimited(df, fields, "LL")
    assert got.columns == ["Record Type", "a", "a_1"]
    assert sorted(rows_of(got), key=str) == sorted([("LL", "1", "2"), ("LL", "1", None), ("LL", " 1 ", "")], key=str)


def test_item_groups_and_types(spark):
    df = spark.createDataFrame([("f", i, n) for i, n in enumerate([1, 2, 1, 2, 1, 1])], "file string, pos int, item_no int")
    got = {r["pos"]: r["group_id"] for r in layout.item_groups(df).collect()}
    assert [got[i] for i in range(6)] == [-1, -1, 0, 0, 1, 1]


def test_clean_layout(spark):
    rows = [(0, "1", "Record Type = H", "x"), (1, "2", "File\nName", "x"), (2, "1", "Amount", "x"), (3, "2", "Length of Record", "x"), (4, "1", "Record Type (P=Pool)", "x"), (5, "2", None, None), (6, "Col0", "Col1", "x"), (7, "none", "z", "x"), (8, "3", None, "x")]
    df = spark.createDataFrame([("f", *r) for r in rows], "file string, pos int, item string, field_name string, notation string")
    got = {r["pos"]: (r["field_name"], r["record_type"]) for r in layout.clean_layout(df, ["field_name", "notation"]).collect()}
    assert got == {0: ("Record Type = H", "H"), 1: ("File Name", "H"), 4: ("Record Type (P=Pool)", "P"), 8: (None, "P")}


def test_version_for(spark):
    files = spark.createDataFrame([("a", date(2014, 1, 1)), ("a", date(2030, 1, 1)), ("b", date(2014, 1, 1))], "series string, day date")
    versions = spark.createDataFrame([("a", "v1", None, date(2014, 1, 1)), ("a", "v2", date(2013, 6, 1), date(2015, 1, 1)), ("a", "v3", date(2016, 1, 1), None)], "series string, version string, version_from date, version_to date")
    got = {(r["series"], r["day"].year): (r["version"], r["overlap"]) for r in layout.version_for(files, versions).collect()}
    assert got == {("a", 2014): ("v2", True), ("a", 2030): ("v3", False), ("b", 2014): (None, False)}


def test_coverage_report(spark):
    r = [("x", date(2013, 9, 1), date(2013, 11, 1)), ("x", date(2013, 12, 1), date(2015, 3, 1)), ("x", date(2017, 12, 1), date(2021, 1, 1)), ("x", date(2021, 2, 1), date(2099, 12, 31)), ("y", date(2021, 8, 1), date(2022, 1, 1))]
    df = spark.createDataFrame(r, "series string, start date, end date")
    got = {x["series"]: x.asDict() for x in coverage.coverage(df, F.lit("2025-08-21").cast("date")).collect()}
    assert (got["x"]["expected"], got["x"]["missing"], got["x"]["gaps"], got["x"]["has_gaps"]) == (144, 32, "2015-04 to 2017-11", True)
    assert (got["y"]["expected"], got["y"]["covered"], got["y"]["coverage_pct"], got["y"]["gaps"]) == (6, 6, 100.0, "None")


def test_miss_runs_stop(spark):
    hits = [True, False, False, True, False, False, False, True]
    df = spark.createDataFrame([("s", i, h) for i, h in enumerate(hits)], "series string, step int, hit boolean")
    got = sorted((r["step"], r["misses"]) for r in coverage.miss_runs(df, 3).collect())
    assert got == [(0, 0), (1, 1), (2, 2), (3, 0), (4, 1), (5, 2), (6, 3)]


def test_ledger(spark):
    df = spark.createDataFrame([("s", "a", "P", "success", 3), ("s", "b", "P", "failed", 0), ("t", "c", None, "skipped", 0)], "series string, file string, record_type string, status string, n long")
    got = {r["series"]: (r["attempted"], float(r["success_rate"])) for r in ledger.run_summary(df).collect()}
    assert got == {"s": (2, 50.0), "t": (0, 0.0)}


def test_union_and_canonical(spark):
    a = spark.createDataFrame([("x", "3", None)], "`Data Item` string, `Length` string, `Max Length` string")
    b = spark.createDataFrame([("y", "4", "X")], "`Data Element` string, `Max Length` string, `Format` string")
    got = layouts.canonical(layouts.union_layouts([a, b])).select("field_name", "length", "notation")
    assert sorted(rows_of(got)) == [("x", 3, None), ("y", 4, "X")]


def test_catalog(spark):
    got = layouts.read_catalog(spark, {"a": {"min_date": "201309", "extension": "zip", "date_format": "%Y%m", "frequency": "quarterly"}}).first()
    assert got["min_date"] == date(2013, 9, 1) and got["max_date"] is None and got["frequency"] == "quarterly"


def test_layout_csv(spark, tmp_path):
    (tmp_path / "x (Sep 2013 - Present).csv").write_text('Item,Data Item,Length,Remarks\n1,"Record\nType",1,X\n2,File Name,4,X(4)\n')
    got = layouts.read_layout_csv(spark, str(tmp_path)).orderBy("pos").collect()
    assert [r["Data Item"] for r in got] == ["Record\nType", "File Name"] and got[0]["version_from"] == date(2013, 9, 1)


def test_stage_and_transform(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    with zipfile.ZipFile(src / "s_202101.zip", "w") as z:
        z.writestr("a.TXT", b"Habcdxx012\r\nPbad\xe9xx001\r\n")
        z.writestr("b.pdf", b"no")
    (src / "s_202102.TXT").write_bytes(b"Hefghxx003\n\nHbad\xe9xx004\n")
    (src / "s_extra_202102.txt").write_text("Hzzzz")
    (src / "s_202103.zip").write_bytes(b"not a zip")
    staged, clean = str(tmp_path / "staged"), str(tmp_path / "clean")
    got = {r["file"]: (r["status"], r["n"]) for r in jobs.stage_series(spark, str(src), staged, "s").collect()}
    assert got["s_202101.zip"] == ("success", 2) and got["s_202102.TXT"] == ("success", 3) and got["s_202103.zip"][0] == "failed"
    out = jobs.transform_series(spark, staged, clean, "s", {"H": H, "Q": H}, jobs.FIXED_WIDTH, record_types=["H", "nope"])
    assert rows_of(out.select("record_type", "status", "n")) == [("H", "success", 3)] or out.count() == 1
    names = {r[0] for r in spark.read.parquet(f"{clean}/s/record_type=H").select("File Name").collect()}
    assert {"abcd", "efgh", "badé"} <= names
    done = jobs.stage_series(spark, str(src), staged, "s", spark.createDataFrame([("s", "s_202101.zip", "success")], "series string, file string, status string"))
    assert {r["file"]: r["status"] for r in done.collect()}["s_202101.zip"] == "skipped"


def test_staging_keeps_what_other_files_of_the_period_gave(spark, tmp_path):
    """A period that comes as text and later as an archive, and a period of many characters."""
    src, staged = tmp_path / "src", str(tmp_path / "staged")
    src.mkdir()
    (src / "x_202401.txt").write_text("Habcd\n")
    (src / "x_a_period_that_is_longer_than_twenty.txt").write_text("Hlong\n")
    first = jobs.stage_series(spark, str(src), staged, "x")
    done = spark.createDataFrame(first.collect(), first.schema)
    with zipfile.ZipFile(src / "x_202401.ZIP", "w") as z:
        z.writestr("a.txt", "Hefgh\n")
    second = {r["file"]: r["status"] for r in jobs.stage_series(spark, str(src), staged, "x", done).collect()}
    assert second["x_202401.ZIP"] == "success" and second["x_202401.txt"] == "skipped"
    got = sorted((r["text_content"], r["period"]) for r in lines.read_staged(spark, staged).collect())
    assert got == [("Habcd", "202401"), ("Hefgh", "202401"), ("Hlong", "a_period_that_is_longer_than_twenty")]
    jobs.stage_series(spark, str(src), staged, "x")  # again, and nothing twice
    assert lines.read_staged(spark, staged).count() == 3


def test_broken_archives_are_failures(spark, tmp_path):
    """A member with a bad checksum, an archive without members: no lines of theirs, and the rest goes on."""
    src = tmp_path / "src"
    src.mkdir()
    with zipfile.ZipFile(src / "s_1.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("a.txt", "Hgood\n" * 50)
        z.writestr("b.txt", "Hbroken\n" * 50)
    raw = (src / "s_1.zip").read_bytes()
    (src / "s_1.zip").write_bytes(raw.replace(b"Hbroken\nHbroken", b"Hbr0ken\nHbroken", 1))
    with zipfile.ZipFile(src / "s_2.zip", "w") as z:
        z.writestr("a.pdf", "no")
    with zipfile.ZipFile(src / "s_3.zip", "w") as z:
        z.writestr("a.dat", "Hok\n")
    got = {r["file"]: (r["status"], r["n"], r["error"]) for r in jobs.stage_series(spark, str(src), f"{tmp_path}/staged", "s").collect()}
    assert got["s_1.zip"][:2] == ("failed", 0) and "CRC" in got["s_1.zip"][2]
    assert got["s_2.zip"] == ("failed", 0, "no text member") and got["s_3.zip"] == ("success", 1, None)
    assert [r["text_content"] for r in lines.read_staged(spark, f"{tmp_path}/staged").collect()] == ["Hok"]


def version_rows(spark):
    old = [("V1", None, date(2021, 1, 31), "H", i + 1, f.name, f.length, f.notation) for i, f in enumerate(H)]
    new = [("V2", date(2021, 2, 1), None, "H", i + 1, *x) for i, x in enumerate([("Record Type", 1, "X"), ("Count", 3, "9(3)"), ("File Name", 4, "X(4)")])]
    lay = spark.createDataFrame(old + new, "version string, version_from date, version_to date, record_type string, ordinal int, field_name string, length int, notation string")
    return lay.withColumns({"series": F.lit("s"), "Begin": F.lit("1"), "End": F.lit("2")})


def test_run_series_by_version(spark, tmp_path):
    """Each file by the layout of its time; what is done is skipped; files without a layout and unknown formats fail."""
    src, staged, clean = tmp_path / "src", str(tmp_path / "staged"), str(tmp_path / "clean")
    src.mkdir()
    (src / "s_202101.txt").write_text("Habcdxx012\nZ\n")
    (src / "s_202102.txt").write_text("H034efgh\n")
    (src / "s_junk.txt").write_text("H034efgh\n")
    steps, ledgers = jobs.run_series(spark, str(src), staged, clean, "s", version_rows(spark), typed_values=True)
    assert steps == [("stage", "success"), ("transform", "success")]
    ran = ledgers["transform"]
    assert {(r["file"], r["record_type"], r["status"], r["n"]) for r in ran.collect()} == {("s_202101.txt", "H", "success", 1), ("s_202102.txt", "H", "success", 1), ("s_junk.txt", None, "failed", 0)}
    got = spark.read.parquet(f"{clean}/s/record_type=H").select("File Name", "Count")
    assert sorted(rows_of(got)) == [("abcd", 12), ("efgh", 34)]
    done = spark.createDataFrame(ran.collect(), ran.schema)
    again = jobs.transform_all(spark, staged, clean, version_rows(spark), include=["s"], done=done)
    assert Counter(r["status"] for r in again.collect()) == {"skipped": 2, "failed": 1}
    assert jobs.transform_all(spark, staged, clean, version_rows(spark), exclude=["s"]).count() == 0
    unknown = jobs.transform_versions(spark, staged, clean, "s", version_rows(spark).drop("Begin", "End"))
    assert Counter(r["error"] for r in unknown.collect()) == {"unknown format": 2, "no layout for the period": 1}
    steps, _ = jobs.run_series(spark, str(tmp_path / "nowhere"), staged, clean, "s", version_rows(spark))
    assert len(steps) == 1 and steps[0][1].startswith("failed")
    assert jobs.layout_fields(version_rows(spark).filter("version = 'V2'"))["H"][1] == Field("Count", 3, "9(3)")
    all_ = jobs.stage_all(spark, str(src), str(tmp_path / "staged2"), ["s", "t", "s"], exclude=["t"])
    assert Counter(r["series"] for r in all_.collect()) == {"s": 3}


def test_headers_of_their_own(spark, tmp_path):
    """Layout files with different headers in a folder, one without rows, and a folder that is not there."""
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "f (Sep 2013 - Present).csv").write_text("Item,Data Item,Begin,End,Length,Remarks\n1,Record Type,1,1,1,X\n2,Name,2,5,4,X(4)\n")
    (tmp_path / "a" / "g.csv").write_text('Item,Data Element,Type,Max Length,Format\n1,"A\nB",Text,7,9(7)\n')
    (tmp_path / "a" / "h.csv").write_text("Item,Data Item,Length,Remarks\n")
    got = layouts.canonical(layouts.read_layout_csv(spark, str(tmp_path / "a")))
    assert sorted(rows_of(got.select("field_name", "length", "notation", "Begin", "Type")), key=str) == sorted([("Record Type", 1, "X", "1", None), ("Name", 4, "X(4)", "2", None), ("A\nB", 7, "9(7)", None, "Text")], key=str)
    both = layouts.combine_layouts(spark, {"s": str(tmp_path / "a"), "t": str(tmp_path / "b")})
    assert both.select("series", "field_name").distinct().count() == 3


def test_versions_keep_rows_that_repeat(spark):
    """Equal rows of files stay; a shorter version inside a longer one holds while it is valid."""
    files = spark.createDataFrame([("a", date(2014, 1, 1))] * 2 + [("a", date(2014, 7, 1)), ("a", None), (None, date(2014, 1, 1))], "series string, day date")
    versions = spark.createDataFrame([("a", "long", None, None), ("a", "short", date(2013, 6, 1), date(2014, 2, 1))], "series string, version string, version_from date, version_to date")
    got = Counter((r["series"], r["version"], r["overlap"]) for r in layout.version_for(files, versions).collect())
    assert got == {("a", "short", True): 2, ("a", "long", False): 1, ("a", None, False): 1, (None, None, False): 1}


def test_totals_are_told_from_nulls(spark):
    rows = [("a", None, "success", 3), ("a", "P", "success", 4), (None, "P", "success", 1)]
    got = {(r["series"], r["record_type"], r["level"]): r["records"] for r in ledger.records_by_type(spark.createDataFrame(rows, "series string, record_type string, status string, n long")).collect()}
    assert got == {("a", None, 0): 3, ("a", "P", 0): 4, ("a", None, 1): 7, (None, "P", 0): 1, (None, None, 1): 1, (None, None, 3): 8}


def test_expected_files_say_what_they_do_not_know(spark):
    row = lambda fmt, freq: spark.createDataFrame([("s", date(2024, 1, 1), date(2024, 3, 1), "zip", fmt, freq)], "series string, min_date date, max_date date, extension string, date_format string, frequency string")
    day = F.lit("2024-05-01").cast("date")
    assert [r["file_name"] for r in coverage.expected_files(row("%Y-%m-%d", "monthly"), day).orderBy("step").collect()] == ["s_2024-01-31.zip", "s_2024-02-29.zip", "s_2024-03-31.zip"]
    for bad in (row("%Y-%m-%d", "weekly"), row("%d.%m", "monthly")):
        with pytest.raises(Exception, match="unknown"):
            coverage.expected_files(bad, day).collect()


def test_missing_files_within_links(spark):
    expected = spark.createDataFrame([("s_1.zip",), ("s_2.zip",), ("s_3.zip",)], "file_name string")
    hrefs = spark.createDataFrame([("/d/s_1.zip",), ("/get?file=s_2.zip&x=1",)], "href string")
    assert [r[0] for r in coverage.missing_files(expected, hrefs, within=True).collect()] == ["s_3.zip"]
    assert {r[0] for r in coverage.missing_files(expected, hrefs).collect()} == {"s_2.zip", "s_3.zip"}


def test_long_numbers(spark):
    df = spark.createDataFrame([("9" * 17 + "25",)], "v string")
    got = df.select(pic.convert_value("v", pic.parse_pic(F.lit("9(17)v9(2)"))).alias("c"), pic.typed("v", "9(17)v9(2)").alias("t"), pic.typed("v", "9(17)v9(2)", True).alias("e")).first()
    assert got["c"]["number"] == got["t"] == 1e17 and str(got["e"]) == "9" * 17 + ".25"


def test_steps_stop_at_first_failure():
    assert jobs.run_steps([("a", lambda: 1), ("b", lambda: 1 / 0), ("c", lambda: 1)]) == [("a", "success"), ("b", "failed: ZeroDivisionError: division by zero")]


def test_ingest_once(spark, tmp_path):
    src, out, ck = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    src.mkdir()
    fields = [Field("Record_Type", 1), Field("Name", 4)]
    (src / "s_1.txt").write_text("Habcd\nPxxxx\n")
    ingest(spark, str(src), out, ck, "s", fields, "H")
    (src / "s_2.txt").write_text("Hefgh\n")
    ingest(spark, str(src), out, ck, "s", fields, "H")
    ingest(spark, str(src), out, ck, "s", fields, "H")
    assert sorted((r["file"], r["Name"]) for r in spark.read.parquet(out).collect()) == [("s_1.txt", "abcd"), ("s_2.txt", "efgh")]


def test_long_parse_and_work_list(spark):
    df = spark.createDataFrame([("A|1|2",), ("B|3",)], "text_content string")
    lay = spark.createDataFrame([("A", 1, "x"), ("A", 2, "y"), ("B", 1, "z")], "record_type string, pos int, field_name string")
    got = parse.delimited_long(df, lay)
    assert sorted((r["field_name"], r["value"]) for r in got.collect()) == [("x", "1"), ("y", "2"), ("z", "3")]


def test_scratch_is_new(spark):
    assert scratch(spark, "a") != scratch(spark, "a")
    assert lines.MEMBERS == (".txt", ".dat", ".csv")


def test_reports(spark, tmp_path):
    from recordlake.operators import report

    df = spark.createDataFrame([("a", True, ["x", "y"]), ("a", False, []), ("b", True, None)], "series string, hit boolean, l array<string>")
    got = {(r["series"], r["level"]): (r["attempted"], r["obtained"], r["missed"]) for r in report.manifest_counts(df).collect()}
    assert got == {("a", 0): (2, 1, 1), ("b", 0): (1, 1, 0), (None, 1): (3, 2, 1)}
    report.write_report(df, f"{tmp_path}/r")
    back = spark.read.option("header", True).csv(f"{tmp_path}/r")
    assert sorted(r["l"] or "" for r in back.collect()) == ["", "", "x; y"]
    assert [r["name"] for r in report.by_count(spark.createDataFrame([("b", 1), ("a", 1), ("c", 2)], "name string, n long")).collect()] == ["c", "a", "b"]


def simple_lines(spark, rows):
    return spark.createDataFrame(rows, "file string, text_content string")


TWO = {"P": [Field("Record Type", 1), Field("Key", 3, "9(3)")], "Z": [Field("Record Type", 1), Field("Key", 3, "9(3)"), Field("Note", 2)]}


def two_versions(spark, notation=("9(3)", "9(3)")):
    rows = []
    for v, a, b, note in (("V1", None, date(2021, 1, 31), notation[0]), ("V2", date(2021, 2, 1), None, notation[1])):
        for code, fields in TWO.items():
            rows += [(v, a, b, code, i + 1, f.name, f.length, note if f.name == "Key" else f.notation, "1", "2") for i, f in enumerate(fields)]
    return spark.createDataFrame(rows, "version string, version_from date, version_to date, record_type string, ordinal int, field_name string, length int, notation string, Begin string, End string")


def test_a_rerun_replaces_also_by_nothing(spark, tmp_path):
    """Fewer lines of a type, none of it, an empty file: what was there goes, and counts are those of the new rows."""
    staged, clean = str(tmp_path / "staged"), str(tmp_path / "clean")
    lay = two_versions(spark)
    lines.stage(simple_lines(spark, [("s_202101.txt", x) for x in ("P001", "Z00111", "Z00222")] + [("s_202102.txt", "P009")]), staged, "s")
    ran = {(r["file"], r["record_type"]): r["n"] for r in jobs.transform_versions(spark, staged, clean, "s", lay).collect()}
    assert ran == {("s_202101.txt", "P"): 1, ("s_202101.txt", "Z"): 2, ("s_202102.txt", "P"): 1, ("s_202102.txt", "Z"): 0}
    lines.stage(simple_lines(spark, [("s_202101.txt", "P001")]), staged, "s")
    ran = {(r["file"], r["record_type"]): r["n"] for r in jobs.transform_versions(spark, staged, clean, "s", lay).collect()}
    assert ran[("s_202101.txt", "Z")] == 0 and jobs.read_clean(spark, clean, "s", "Z").count() == 0
    assert sorted(r["file"] for r in jobs.read_clean(spark, clean, "s", "P").collect()) == ["s_202101.txt", "s_202102.txt"]
    empty = spark.createDataFrame([("s_202102.txt", "x")], "file string, source string")
    assert lines.stage(simple_lines(spark, []), staged, "s", attempted=empty) == {"s_202102.txt": (0, None)}
    assert [r["file"] for r in lines.read_staged(spark, staged).collect()] == ["s_202101.txt"]
    assert jobs.read_clean(spark, clean, "s", "Z", number=1).count() == 2  # older commits can be read until they are cleared away


def test_rows_of_a_file_that_was_staged_again_without_lines_go(spark, tmp_path):
    """Its rows of all record types go with the next transform, whether of changes only or of all; those of a file that was never staged here stay."""
    staged, clean = str(tmp_path / "staged"), str(tmp_path / "clean")
    lay = two_versions(spark)
    empty = lambda *f: spark.createDataFrame([(x, "again") for x in f], "file string, source string")
    left = lambda: sorted(r["file"] for c in "PZ" for r in jobs.read_clean(spark, clean, "s", c).collect())
    lines.stage(simple_lines(spark, [("s_202104.txt", "P007")]), str(tmp_path / "elsewhere"), "s")
    jobs.transform_versions(spark, str(tmp_path / "elsewhere"), clean, "s", lay)
    lines.stage(simple_lines(spark, [("s_202101.txt", "P001"), ("s_202101.txt", "Z00111"), ("s_202102.txt", "P009"), ("s_202103.txt", "P003")]), staged, "s")
    jobs.transform_versions(spark, staged, clean, "s", lay)
    lines.stage(simple_lines(spark, [("s_202103.txt", "P004")]), staged, "s", attempted=empty("s_202101.txt", "s_202103.txt"))
    assert sorted(r["file"] for r in lines.staged_files(spark, staged, "s").collect()) == ["s_202102.txt", "s_202103.txt"]
    ran = {(r["file"], r["record_type"]): (r["status"], r["n"]) for r in jobs.transform_versions(spark, staged, clean, "s", lay, changed_only=True).collect()}
    assert ran[("s_202101.txt", "P")] == ran[("s_202101.txt", "Z")] == ("success", 0) and ran[("s_202103.txt", "P")] == ("success", 1)
    assert left() == ["s_202102.txt", "s_202103.txt", "s_202104.txt"]
    lines.stage(simple_lines(spark, []), staged, "s", attempted=empty("s_202102.txt", "s_202103.txt"))
    jobs.transform_versions(spark, staged, clean, "s", lay)
    assert left() == ["s_202104.txt"]
    lines.stage(simple_lines(spark, [("s_202102.txt", "P001")]), staged, "s")
    jobs.transform_versions(spark, staged, clean, "s", lay)
    assert left() == ["s_202102.txt", "s_202104.txt"]


def test_a_write_that_breaks_off_changes_nothing(spark, tmp_path, monkeypatch):
    staged = str(tmp_path / "staged")
    lines.stage(simple_lines(spark, [("s_1.txt", "old"), ("s_2.txt", "two")]), staged, "s")
    with monkeypatch.context() as m:
        m.setattr(commits.Commits, "_put", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            lines.stage(simple_lines(spark, [("s_1.txt", "new"), ("s_1.txt", "newer")]), staged, "s")
    assert sorted(r["text_content"] for r in lines.read_staged(spark, staged).collect()) == ["old", "two"]
    assert lines.stage(simple_lines(spark, [("s_1.txt", "new")]), staged, "s") == {"s_1.txt": (1, None)}
    table = commits.Commits(spark, staged, "series")
    assert sorted(r["text_content"] for r in lines.read_staged(spark, staged).collect()) == ["new", "two"]
    assert len(table.vacuum(1)) == 1  # of the write that broke off; the first batch still holds s_2
    assert sorted(r["text_content"] for r in lines.read_staged(spark, staged).collect()) == ["new", "two"]


def test_of_two_commits_one_is_told(spark, tmp_path, monkeypatch):
    """Another commit between the look and the rename: both are there in the end."""
    table, put, other = commits.Commits(spark, str(tmp_path / "t"), "series"), commits.Commits._put, []

    def late(self, path, content):
        if "_commits" in path and not other:
            other.append(1)
            commits.Commits(spark, str(tmp_path / "t"), "series").commit("b", [("s", "1", "s_1", 5, "x")], [("s_1", ["s"], None)])
        return put(self, path, content)

    monkeypatch.setattr(commits.Commits, "_put", late)
    assert table.commit("a", [("s", "2", "s_2", 7, "x")], [("s_2", ["s"], None)]) == 2
    assert sorted((r["file"], r["n"], r["batch"]) for r in table.entries().collect()) == [("s_1", 5, "b"), ("s_2", 7, "a")]


def test_one_scan_for_all_record_types(spark, tmp_path, monkeypatch):
    """Two versions read the partitions of their own periods, each once; columns that clash keep their types."""
    staged, clean = str(tmp_path / "staged"), str(tmp_path / "clean")
    lines.stage(simple_lines(spark, [(f"s_20210{m}.txt", x) for m in (1, 2, 3) for x in ("P001", "Z002ab", "Qxxxxx")]), staged, "s")
    seen = []

    def spied(rows, *a, **k):
        filters = rows._jdf.queryExecution().optimizedPlan().toString()
        seen.append([m for m in ("202101", "202102", "202103") if m in filters])
        return parse.by_type(rows, *a, **k)

    monkeypatch.setattr(jobs, "by_type", spied)
    jobs.transform_versions(spark, staged, clean, "s", two_versions(spark), typed_values=True)
    assert seen == [["202101"], ["202102", "202103"]]  # a select for each version, for all record types, over its own periods
    z = jobs.read_clean(spark, clean, "s", "Z")
    assert z.columns == ["Record Type", "Key", "Note", "period", "file"] and sorted((r["Key"], r["Note"]) for r in z.collect()) == [(2, "ab")] * 3
    assert jobs.read_clean(spark, clean, "s", "P").columns == ["Record Type", "Key", "period", "file"]
    lay = {"P": [Field("Record Type", 1), Field("Amount", 3, "9(3)")], "Z": [Field("Record Type", 1), Field("AMOUNT", 3, "X(3)")]}
    placed = parse.placed_columns([lay], typed_values=True)
    assert [p.column for p in placed["P"]] == ["Record Type", "Amount"] and [p.column for p in placed["Z"]] == ["Record Type", "AMOUNT (Z)"]
    got = parse.by_type(spark.createDataFrame([("P012",), ("Zabc",), ("PP",)], "text_content string"), lay, placed, typed_values=True).collect()
    assert [(r["record_type"], r["Amount"], r["AMOUNT (Z)"]) for r in got] == [("P", 12, None), ("Z", None, "abc"), ("P", None, None)]


def test_scan_of_a_version_is_pruned(spark, tmp_path):
    staged = str(tmp_path / "staged")
    lines.stage(simple_lines(spark, [(f"s_20210{m}.txt", "P001") for m in (1, 2, 3)]), staged, "s")
    spark.conf.set("spark.sql.maxMetadataStringLength", 100_000)
    rows = lines.read_staged(spark, staged).filter(F.col("period").isin(["202102"]))
    plan = rows._jdf.queryExecution().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "202102" in plan.partition("PartitionFilters")[2].partition("PushedFilters")[0]
    assert rows.count() == 1


def test_lines_of_several_record_types(spark):
    """A code that is the beginning of another, delimiters, a layout without record types, and fields that a line lacks."""
    lay = {"H": [Field("Record Type"), Field("a")], "HH": [Field("Record Type"), Field("b"), Field("c")], None: [Field("x"), Field("y")]}
    placed = parse.placed_columns([lay])
    got = parse.by_type(spark.createDataFrame([("H|1",), ("HH|2",), ("T|3",)], "text_content string"), lay, placed, delimiter="|").collect()
    assert Counter((r["record_type"], r["a"], r["b"], r["c"], r["y"]) for r in got) == Counter({("H", "1", None, None, None): 1, ("HH", None, "2", None, None): 1, ("ALL", None, None, None, "1"): 1, ("ALL", None, None, None, "2"): 1, ("ALL", None, None, None, "3"): 1})
    assert parse.disambiguated([Field("A"), Field("A"), Field("A_1"), Field("a")]) == ["A", "A_1", "A_1_1", "a_2"]


def test_types_that_hold_both(spark, tmp_path):
    """Decimals of two versions, and a column that another batch knows as text."""
    from pyspark.sql import types as T

    d, common = T.DecimalType, kinds.common_type
    assert common(d(15, 2), d(17, 4)) == d(17, 4) and common(d(15, 2), d(12, 4)) == d(17, 4) and common(d(38, 0), d(10, 5)) == T.StringType()
    assert common(T.LongType(), d(5, 2)) == d(21, 2) and common(T.DoubleType(), T.LongType()) == T.DoubleType() and common(T.IntegerType(), T.LongType()) == T.LongType()
    assert common(T.DateType(), T.DateType()) == T.DateType() and common(T.DateType(), T.TimestampType()) == T.TimestampType() and common(T.DateType(), T.LongType()) == T.StringType()
    staged, clean = str(tmp_path / "staged"), str(tmp_path / "clean")
    lines.stage(simple_lines(spark, [("s_202101.txt", "P123"), ("s_202102.txt", "P456")]), staged, "s")
    jobs.transform_versions(spark, staged, clean, "s", two_versions(spark, ("9(2)v9(1)", "9(1)v9(2)")), typed_values=True, exact=True)
    got = jobs.read_clean(spark, clean, "s", "P")
    assert dict(got.dtypes)["Key"] == "decimal(4,2)" and sorted(str(r["Key"]) for r in got.collect()) == ["12.30", "4.56"]
    lines.stage(simple_lines(spark, [("s_202102.txt", "Px y")]), staged, "s")
    jobs.transform_versions(spark, staged, clean, "s", two_versions(spark, ("9(2)v9(1)", "X(3)")), typed_values=True, exact=True, changed_only=True)
    got = jobs.read_clean(spark, clean, "s", "P")
    assert dict(got.dtypes)["Key"] == "string" and sorted(r["Key"] for r in got.collect()) == ["12.30", "x y"]


def test_only_what_changed(spark, tmp_path):
    """A changed cell of one version, a changed file, other options: just what depends on them runs again."""
    staged, clean = str(tmp_path / "staged"), str(tmp_path / "clean")
    src = tmp_path / "src"
    src.mkdir()
    for m in (1, 2):
        (src / f"s_20210{m}.txt").write_text("P001\nZ002ab\n")

    def status(lay, **options):
        return {(r["file"][2:8], r["record_type"]): r["status"] for r in jobs.transform_versions(spark, staged, clean, "s", lay, changed_only=True, **options).collect()}

    jobs.stage_series(spark, str(src), staged, "s")
    assert set(status(two_versions(spark)).values()) == {"success"}
    assert set(status(two_versions(spark)).values()) == {"skipped"}
    assert {r["status"] for r in jobs.stage_series(spark, str(src), staged, "s", changed_only=True).collect()} == {"skipped"}
    changed = two_versions(spark).withColumn("length", F.when((F.col("version") == "V2") & (F.col("field_name") == "Note"), 1).otherwise(F.col("length")))
    assert status(changed) == {("202101", "P"): "skipped", ("202101", "Z"): "skipped", ("202102", "P"): "skipped", ("202102", "Z"): "success"}
    assert sorted(r["Note"] for r in jobs.read_clean(spark, clean, "s", "Z").collect()) == ["a", "ab"]
    (src / "s_202101.txt").write_text("P001\nP002\n")
    assert {r["file"]: r["status"] for r in jobs.stage_series(spark, str(src), staged, "s", changed_only=True).collect()} == {"s_202101.txt": "success", "s_202102.txt": "skipped"}
    assert {k for k, v in status(changed).items() if v == "success"} == {("202101", "P"), ("202101", "Z")}
    assert set(status(changed, typed_values=True).values()) == {"success"}


def test_counts_come_out_of_the_write(spark):
    """More codes than a histogram takes, codes without rows, and codes that many tasks share."""
    df = spark.range(0, 20_000, 1, 7).withColumn("code", (F.col("id") % 600).cast("int")).filter("code <> 5")
    rows, counts = commits.counted(df, "code", 700, chunk=64)
    rows.write.format("noop").mode("overwrite").save()
    assert counts() == {k: len(range(k, 20_000, 600)) for k in range(600) if k != 5}


def test_texts_are_read_again_only_if_they_are_not_utf8(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "s_1.txt").write_bytes("é\n".encode() + b"bad\xe9\n")
    (src / "s_2.txt").write_bytes("é\n\n".encode())
    (src / "s_3.txt").write_bytes(b"")
    got = {r["file"]: (r["status"], r["n"], r["error"]) for r in jobs.stage_series(spark, str(src), f"{tmp_path}/staged", "s").collect()}
    assert got == {"s_1.txt": ("success", 2, None), "s_2.txt": ("success", 2, None), "s_3.txt": ("failed", 0, "no lines")}
    assert sorted(r["text_content"] for r in lines.read_staged(spark, f"{tmp_path}/staged").collect()) == sorted(["", "badé", "é", "Ã©"])


def test_members_over_tasks(spark, tmp_path):
    """Several members are several tasks; a broken member fails alone; nothing is staged of it, in either mode."""
    import numpy as np

    raw = np.random.default_rng(0).integers(97, 122, 200_000, np.uint8).tobytes()
    with zipfile.ZipFile(tmp_path / "s_1.zip", "w", zipfile.ZIP_DEFLATED) as z:
        for k in range(5):
            z.writestr(f"{k}.txt", b"".join(raw[i : i + 50] + b"\r\n" for i in range(k, 100_000, 50)))
        z.writestr("no.pdf", "x")
    with zipfile.ZipFile(tmp_path / "s_2.zip", "w", zipfile.ZIP_STORED) as z:
        z.writestr("a.txt", "Hgood\n" * 50)
        z.writestr("b.txt", "Hbroken\n" * 50)
        z.writestr("c.txt", "Hlast")
    broken = tmp_path / "s_2.zip"
    broken.write_bytes(broken.read_bytes().replace(b"Hbroken\nHbroken", b"Hbr0ken\nHbroken", 1))
    df = archives.zip_lines(spark, [f"file:{tmp_path}/s_1.zip", f"file:{tmp_path}/s_2.zip"], sure=True, task_bytes=50_000)
    assert df.rdd.getNumPartitions() >= 5
    got = Counter((r["path"][-7:], r["member"], r["error"] is not None) for r in df.collect())
    assert got == Counter({("s_1.zip", f"{k}.txt", False): 2000 for k in range(5)} | {("s_2.zip", "a.txt", False): 50, ("s_2.zip", "b.txt", True): 1, ("s_2.zip", "c.txt", False): 1})
    held = lines.unzip(spark.read.format("binaryFile").load(f"{tmp_path}/s_2.zip"), sure=True)
    assert Counter(r["member"] for r in held.collect()) == {"a.txt": 50, "b.txt": 1, "c.txt": 1}
    ran = {r["file"]: (r["status"], r["n"], bool(r["error"])) for r in jobs.stage_series(spark, str(tmp_path), f"{tmp_path}/a", "s", strict=False).collect()}
    assert ran == {"s_1.zip": ("success", 10_000, False), "s_2.zip": ("success", 51, True)}
    assert lines.read_staged(spark, f"{tmp_path}/a").filter("file = 's_2.zip'").count() == 51
    ran = {r["file"]: (r["status"], r["n"]) for r in jobs.stage_series(spark, str(tmp_path), f"{tmp_path}/b", "s").collect()}
    assert ran == {"s_1.zip": ("success", 10_000), "s_2.zip": ("failed", 0)}
    assert lines.read_staged(spark, f"{tmp_path}/b").select("file").distinct().count() == 1


def test_a_member_of_more_than_two_gigabytes():
    """A stored member of three gigabytes that no one holds: it is read in chunks, and checked to its end."""
    line = b"x" * ((1 << 20) - 1) + b"\n"
    n = 3000

    class Fake:
        """A local header, n times a line, and nothing else."""

        at, most = 0, 0

        def seek(self, at, whence=0):
            self.at = at

        def read(self, k):
            self.most = max(self.most, k)
            if self.at < 30:
                out = (b"PK\x03\x04" + bytes(26))[self.at : self.at + k]
            else:
                lo = (self.at - 30) % len(line)
                out = (line[lo:] + line)[:k] if self.at - 30 < n * len(line) else b""
            self.at += len(out)
            return out

    crc = 0
    import zlib

    for _ in range(n):
        crc = zlib.crc32(line, crc)
    file = Fake()
    member = archives.Member("p", "m.txt", 0, 0, n * len(line), n * len(line), crc)
    count = 0
    for batch in archives.read_member(file, member, False):
        assert batch.nbytes < 2 * archives.BATCH_BYTES and batch.column("error").null_count == batch.num_rows
        count += batch.num_rows
    assert count == n and n * len(line) > 1 << 31 and file.most <= archives.CHUNK
    wrong = archives.Member("p", "m.txt", 0, 0, 5 * len(line), 5 * len(line), 1)
    assert [b.column("error")[0].as_py() for b in archives.read_member(Fake(), wrong, True)] == ["BadZipFile: Bad CRC-32 for file 'm.txt'"]


def test_stream_over_layout_versions(spark, tmp_path, monkeypatch):
    """Files of two versions, a run that dies between write and commit, files that come later: each line once."""
    src, clean, ck = tmp_path / "in", str(tmp_path / "clean"), str(tmp_path / "ck")
    src.mkdir()
    lay, ledgers = version_rows(spark), []
    run = lambda: ingest_versions(spark, str(src), clean, ck, "s", lay, options=jobs.Options(typed_values=True), files_per_batch=1, on_ledger=lambda df: ledgers.extend(df.collect()))
    (src / "s_202101.txt").write_text("Habcdxx012\nZ\n")
    run()
    (src / "s_202102.txt").write_text("H034efgh\n")
    (src / "s_junk.txt").write_text("H034efgh\n")
    with monkeypatch.context() as m:
        m.setattr(commits.Commits, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(Exception, match="killed"):
            run()
    run()
    run()
    got = jobs.read_clean(spark, clean, "s", "H")
    assert sorted((r["File Name"], r["Count"], r["period"]) for r in got.collect()) == [("abcd", 12, "202101"), ("efgh", 34, "202102")]
    assert Counter((r["file"], r["status"], r["n"]) for r in ledgers if r["status"] == "success") == {("s_202101.txt", "success", 1): 1, ("s_202102.txt", "success", 1): 1}
    assert {r["error"] for r in ledgers if r["file"] == "s_junk.txt"} == {"no layout for the period"}


def test_wide_layouts_and_names_that_repeat(spark, tmp_path):
    names = [f"c{k}" for k in range(77)] + ["A", "A", "A_1"]
    (tmp_path / "w.csv").write_text(",".join(names) + "\n" + ",".join(str(k) for k in range(80)) + "\n" + "1,2\n")
    (tmp_path / "x.csv").write_text("a,C0,a\n5,6,7\n")
    got = layouts.read_layout_csv(spark, str(tmp_path))
    assert {"c76", "A", "A_1", "A_1_1"} <= set(got.columns) and len(got.columns) == 84
    rows = {r["layout_file"]: r for r in got.filter("c1 = '1' or layout_file = 'x.csv'").collect()}
    assert [rows["w.csv"][c] for c in ("c0", "c76", "A", "A_1", "A_1_1")] == ["0", "76", "77", "78", "79"]
    assert [rows["x.csv"][c] for c in ("A", "c0", "A_1", "c76")] == ["5", "6", "7", None]
    (tmp_path / "y.csv").write_text("a\n1,2\n")
    with pytest.raises(Exception, match="record 2 has 2 cells"):
        layouts.read_layout_csv(spark, str(tmp_path)).collect()


def test_a_long_layout_file_is_read_some_rows_at_a_time(spark, tmp_path):
    """No file is held as a whole: rows leave in batches, records that are too long are told by their number, quoted newlines stay."""
    file = tmp_path / "Long V1.0 (Sep 2013 - Nov 2013).csv"
    file.write_bytes(b"A,B\r\n" + b"".join(b'%d,"x\r\ny"\r\n' % k for k in range(9000)))
    (tmp_path / "none.csv").write_text("A,C\n\n")
    with open(file, newline="") as text:
        sizes = [len(rows) for header, rows in layouts.row_batches("f", text, 4000) if header == ["A", "B"]]
    assert sizes == [4000, 4000, 1000]
    with open(file, newline="") as text:
        assert max(len(rows) for _, rows in layouts.row_batches("f", text, 4000, 1000)) == 500
    with pytest.raises(ValueError, match="f: record 4 has 3 cells, its header 1"):
        list(layouts.row_batches("f", io.StringIO("a\n1\n\n2\n1,2,3\n"), 2))
    got = layouts.read_layout_csv(spark, str(tmp_path))
    rows = got.orderBy("pos").collect()
    assert [r["A"] for r in rows] == [str(k) for k in range(9000)] and {r["B"] for r in rows} == {"x\r\ny"} and "C" not in got.columns
    assert rows[0]["version_from"] == date(2013, 9, 1) and "wholetext" not in got._jdf.queryExecution().executedPlan().toString().lower()


def test_catalog_dates(spark):
    want = {"2024-01-15": 15, "2024/01/15": 15, "01/15/2024": 15, "01-15-2024": 15, "20240115": 15, "202401": 1, "20240115103000": 15}
    got = layouts.read_catalog(spark, {t: {"min_date": t, "max_date": "", "extension": "zip", "date_format": "%Y%m"} for t in want}).collect()
    assert {r["series"]: r["min_date"] for r in got} == {t: date(2024, 1, d) for t, d in want.items()} and all(r["max_date"] is None for r in got)
    for bad in ("2024-02-30", "soon"):
        with pytest.raises(Exception, match="not a date"):
            layouts.read_catalog(spark, {"s": {"min_date": bad}}).collect()


def test_header_step_of_the_clean(spark):
    df = spark.createDataFrame([("f", 0, "1", "Record Type = H", "x")], "file string, pos int, item string, `Data\nItem` string, `data  item` string")
    got = layout.clean_layout(df, ["Data Item"], name="Data Item", headers=True)
    assert got.columns[:5] == ["file", "pos", "item", "Data Item", "data item_1"] and got.first()["record_type"] == "H"
