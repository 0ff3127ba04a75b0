"""Picture notation of field types: X, X(n), 9(n), 9(m)v9(n)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import col

# The notations that are understood
_TEXT, _INT, _DEC = r"^X(?:\((\d+)\))?$", r"^9\((\d+)\)$", r"^9\((\d+)\)v9\((\d+)\)$"


def parse_pic(notation: str | Column) -> Column:
    """struct(dtype, decimals, length, pattern) of a notation, or null if it is none of the four."""
    n = F.trim(col(notation))
    num = lambda p, g: F.regexp_extract(n, p, g).try_cast("int")

    def info(dtype: str, decimals: Column, length: Column, char: str) -> Column:
        pattern = F.concat(F.lit(f"^{char}{{"), length.cast("string"), F.lit("}$"))
        return F.struct(F.lit(dtype).alias("dtype"), decimals.cast("int").alias("decimals"), length.cast("int").alias("length"), pattern.alias("pattern"))

    zero = F.lit(0)
    return (
        F.when(n.rlike(_TEXT), info("string", zero, F.coalesce(num(_TEXT, 1), F.lit(1)), "."))
        .when(n.rlike(_DEC), info("float64", num(_DEC, 2), num(_DEC, 1) + num(_DEC, 2), "[0-9]"))
        .when(n.rlike(_INT), info("Int64", zero, num(_INT, 1), "[0-9]"))
    )


def convert_value(raw: str | Column, info: Column) -> Column:
    """struct(text, whole, number): the value in the slot of its type; a raw value without a known type is text.

    A number that does not parse is null. An implied point divides by the power of ten; up to 38 digits are read.
    """
    r, kind = col(raw), F.coalesce(info["dtype"], F.lit("string"))
    whole, digits = r.try_cast("bigint"), r.try_cast(T.DecimalType(38, 0))
    return F.struct(
        F.when(kind == "string", r).alias("text"),
        F.when(kind == "Int64", whole).alias("whole"),
        F.when(kind == "float64", digits.cast("double") / F.pow(F.lit(10.0), info["decimals"])).alias("number"),
    )


def validate_value(raw: str | Column, info: Column) -> Column:
    """struct(is_valid, error_message) of a raw value under its notation."""
    r = col(raw)
    # What is said of a value
    error = (
        F.when(info.isNull(), F.lit("No format information provided"))
        .when(r.isNull(), F.lit("Value must be a string"))
        .when(F.length(r) != info["length"], F.concat(F.lit("Expected length "), info["length"].cast("string"), F.lit(", got "), F.length(r).cast("string")))
        .when((info["dtype"] != "string") & ~r.rlike("^[0-9]*$"), F.lit("Value contains non-numeric characters"))
        .when((info["dtype"] == "string") & r.rlike(r"\n"), F.lit("Value does not match expected pattern"))
    )
    return F.struct(error.isNull().alias("is_valid"), error.alias("error_message"))


def augment(layout: DataFrame, notation: str = "notation", dtype: str = "dtype") -> DataFrame:
    """layout with its type column filled in where the notation parses; types that stand there already stay otherwise."""
    new = parse_pic(notation)["dtype"]
    return layout.withColumn(dtype, F.coalesce(new, F.col(dtype)) if dtype in layout.columns else new)


def spark_type(notation: str | None, exact: bool = False) -> T.DataType:
    """Type of a field for a notation; exact gives decimals for implied points and long integers. Also p.s and dates."""
    import re

    n = (notation or "").strip()
    if m := re.fullmatch(r"9\((\d+)\)v9\((\d+)\)", n):
        p, s = int(m[1]) + int(m[2]), int(m[2])
        return T.DecimalType(min(p, 38), s) if exact else T.DoubleType()
    if m := re.fullmatch(r"9\((\d+)\)", n):
        return T.DecimalType(min(int(m[1]), 38), 0) if int(m[1]) > 18 else T.LongType()
    if exact and (m := re.fullmatch(r"(\d+)\.(\d+)", n)):
        return T.DecimalType(min(int(m[1]) + int(m[2]), 38), int(m[2]))
    if exact and n in ("CCYYMMDD", "YYYYMMDD", "CCYYMM", "YYYYMM"):
        return T.DateType()
    return T.StringType()


def typed(raw: str | Column, notation: str | None, exact: bool = False) -> Column:
    """The raw value as its spark_type; null where it does not parse."""
    r, kind = col(raw), spark_type(notation, exact)
    if isinstance(kind, T.DateType):
        return F.try_to_timestamp(r, F.lit("yyyyMMdd" if len(notation.strip()) == 8 else "yyyyMM")).cast("date")
    if isinstance(kind, T.StringType):
        return r
    if "v" in (notation or ""):
        scale = int(notation.rpartition("(")[2].rstrip(") "))
        if exact:
            return (r.try_cast(T.DecimalType(38, 0)) / F.lit(10**scale)).cast(kind)
        return r.try_cast(T.DecimalType(38, 0)).cast("double") / F.lit(float(10**scale))
    return r.try_cast(kind)


def dtype_map(rows: list[tuple[str | None, str | None]], exact: bool = False) -> T.StructType:
    """Schema of a layout's (name, notation) rows: rows without either are skipped, of rows with the same name the last holds."""
    fields: dict[str, T.DataType] = {}
    for name, notation in rows:
        if name and notation:
            fields[name] = spark_type(notation, exact)
    return T.StructType([T.StructField(n, k) for n, k in fields.items()])
