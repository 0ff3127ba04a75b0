from datetime import date

import pytest
from pyspark.sql import functions as F

from recordlake.functions import dates, names, pic, text


def one(spark, column, **values):
    schema = ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'date' if isinstance(v, date) else 'binary'}" for k, v in values.items())
    return spark.createDataFrame([tuple(values.values())], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("name", "code"),
    [
        ("Record Type = HH", "HH"), ("Record Type (F=Loan Level)", "F"), ("Record Type H = File Header", "H"), ("Record Type (90)", "90"), ("Record Type", None),
        ("record type=zz", "ZZ"), ("Record Type of loan", "OF"), ("Pool ID", None), (None, None), (" Record Type ", None),
    ],
)
def test_record_type_code(spark, name, code):
    assert one(spark, names.record_type_code("n"), n=name) == code


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("% of UPB", "Percent_of_UPB"), ("Issuer ID *", "Issuer_ID"), ("Loan To Value (LTV)", "Loan_To_Value"), ("File Name (X)", "File_Name"), ("a filler b", "Filler"), ("Record Type = HH", "Record Type"),
        ("30+ Days", "Field_30_Plus_Days"), ("WAGM (ARM pools only)", "WAGM_ARM"), ("Issuer Name (Short Name)", "Issuer_Name_Short"), ("a–b\r\nc", "a_b_c"), ("", ""), (None, None), ("_x_", "x"),
    ],
)
def test_standard_name(spark, name, want):
    assert one(spark, names.standard_name("n"), n=name) == want


def test_distinct_names():
    assert names.distinct_names(["a\nb", "a  b", "c"]) == ["a b", "a b_1", "c"]


@pytest.mark.parametrize(
    ("notation", "want"),
    [
        ("X(9)", ("string", 0, 9)), ("X", ("string", 0, 1)), ("9(6)", ("Int64", 0, 6)), ("9(13)v9(2)", ("float64", 2, 15)), ("9", None), ("10(9)", None), ("XX", None), ("9(2)V9(3)", None), ("", None), (None, None), (" X(2) ", ("string", 0, 2)),
    ],
)
def test_parse_pic(spark, notation, want):
    got = one(spark, pic.parse_pic("n"), n=notation)
    assert (got and (got["dtype"], got["decimals"], got["length"])) == want


@pytest.mark.parametrize(
    ("raw", "notation", "ok", "error"),
    [
        ("202401", "9(6)", True, None), ("20240A", "9(6)", False, "Value contains non-numeric characters"), ("2024", "9(6)", False, "Expected length 6, got 4"), ("a", "X", True, None),
        ("x", "??", False, "No format information provided"), (None, "X", False, "Value must be a string"),
    ],
)
def test_validate(spark, raw, notation, ok, error):
    got = one(spark, pic.validate_value("r", pic.parse_pic("n")), r=raw, n=notation)
    assert (got["is_valid"], got["error_message"]) == (ok, error)


def test_convert(spark):
    get = lambda raw, n: tuple(one(spark, pic.convert_value("r", pic.parse_pic("n")), r=raw, n=n))
    assert get("000012345000", "9(13)v9(2)") == (None, None, 123450.0)
    assert get("0042", "9(4)") == (None, 42, None)
    assert get("12a", "9(3)") == (None, None, None)
    assert get("", "9(3)") == (None, None, None)
    assert get(" raw ", None) == (" raw ", None, None)


def test_dtype_map():
    s = pic.dtype_map([("a", "X(3)"), ("b", "9(4)"), ("a", "9(2)v9(1)"), (None, "X"), ("c", None), ("d", "9(19)")])
    assert [(f.name, f.dataType.simpleString()) for f in s] == [("a", "double"), ("b", "bigint"), ("d", "decimal(19,0)")]
    assert pic.spark_type("13.2", exact=True).simpleString() == "decimal(15,2)"
    assert pic.spark_type("CCYYMM", exact=True).simpleString() == "date"


@pytest.mark.parametrize(
    ("value", "want"),
    [("202001", "%Y%m"), ("20131231", "%Y%m%d"), ("2024-02-30", None), ("2024/01/31", "%Y/%m/%d"), ("01/31/2024", "%m/%d/%Y"), ("01-31-2024", "%m-%d-%Y"), ("20240131235959", "%Y%m%d%H%M%S"), ("x", None), (None, None)],
)
def test_date_format(spark, value, want):
    assert one(spark, dates.date_format_of("d"), d=value) == want


def test_period_suffix(spark):
    d = date(2024, 2, 1)
    assert one(spark, dates.period_suffix("d", "%Y%m%d", "monthly"), d=d) == "20240229"
    assert one(spark, dates.period_suffix("d", "%Y%m", "quarterly"), d=d) == "202403"
    assert one(spark, dates.period_suffix("d", "%Y%m", "yearly"), d=d) == "202412"
    assert one(spark, dates.period_suffix("d", "%Y%m%d", "yearly", True), d=d) == "20240101"


@pytest.mark.parametrize(
    ("name", "want"),
    [
        ("x V1.0 (Sep 2013 - Nov 2013).csv", (date(2013, 9, 1), date(2013, 11, 1))), ("x V1.8 (Feb 2021 - Present).csv", (date(2021, 2, 1), date(2099, 12, 31))),
        ("x (MBS), JULY 1983.csv", (None, None)), ("x.csv", (None, None)), ("x (a - b).csv", (None, None)),
    ],
)
def test_validity_dates(spark, name, want):
    a, b = dates.validity_dates("n")
    assert tuple(one(spark, F.struct(a.alias("a"), b.alias("b")), n=name)) == want


def test_file_period(spark):
    got = one(spark, dates.file_period("f", "s", "%Y%m"), f="ab_cd_202105.zip", s="ab_cd")
    assert got == date(2021, 5, 1)


def test_text(spark):
    assert one(spark, text.strip("c"), c="\t  a b \n") == "a b"
    assert one(spark, text.strip_line_end("c"), c="a \r\n\r\n") == "a "
    assert one(spark, text.safe_file_name("c"), c='a/b:c*"') == "a_b_c__"
    assert one(spark, text.absolute_link("c", "https://h"), c="/x") == "https://h/x"
    assert one(spark, text.absolute_link("c", "https://h"), c="http://y") == "http://y"
    assert one(spark, text.decode_line("c"), c=b"bad\xe9") == "badé"
    assert one(spark, text.decode_line("c"), c="é".encode()) == "é"
    assert one(spark, text.item_number("c"), c="LR-001") == 1
