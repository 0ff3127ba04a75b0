"""Queries over the given tables that use each operator, and the same in SQL."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import dates, names, pic, text
from .operators import coverage, frequency, layout, ledger, parse, profile, report
from .operators.parse import Field
from .plans import jobs, reports
from .sources import layouts, lines, links
from .sources.scratch import scratch
from .streaming import misses
from .streaming.ingest import ingest, ingest_versions

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


# Lines --------------------------------------------------------------------------------------------------------------

ORDER = [Field("Record Type", 1, "X"), Field("Order Key", 10, "9(10)"), Field("Status", 3, "X(3)"), Field("Order Date", 8, "9(8)"), Field("Amount", 15, "9(13)v9(2)")]
ITEM = [Field("Record Type", 1, "X"), Field("Order Key", 10, "9(10)"), Field("Line", 2, "9(2)"), Field("Quantity", 7, "9(5)v9(2)"), Field("Price", 13, "9(11)v9(2)"), Field("Discount", 5, "9(1)v9(4)"), Field("Ship Date", 8, "9(8)")]


def number(c: str, scale: int, width: int) -> Column:
    return F.lpad(F.round(F.col(c) * 10**scale).cast("bigint").cast("string"), width, "0")


def order_lines(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    line = F.concat(F.lit("P"), number("o_orderkey", 0, 10), F.rpad("o_orderstatus", 3, " "), F.date_format("o_orderdate", "yyyyMMdd"), number("o_totalprice", 2, 15))
    return read(spark, sf_dir, "orders").select(*keep, line.alias("text_content"))


def item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.concat(F.lit("L"), number("l_orderkey", 0, 10), number("l_linenumber", 0, 2), number("l_quantity", 2, 7), number("l_extendedprice", 2, 13), number("l_discount", 4, 5), F.date_format("l_shipdate", "yyyyMMdd"))
    return read(spark, sf_dir, "lineitem").select(line.alias("text_content"))


def snake(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower().replace(" ", "_") for c in df.columns])


@query(
    """SELECT 'P' AS record_type, lpad(o_orderkey::VARCHAR, 10, '0') AS order_key, o_orderstatus AS status, strftime(o_orderdate, '%Y%m%d') AS order_date,
              lpad(round(o_totalprice * 100)::BIGINT::VARCHAR, 15, '0') AS amount FROM orders"""
)
def fixed_width_parse(spark, sf_dir):
    return snake(parse.fixed_width(order_lines(spark, sf_dir), ORDER))


@query(
    """SELECT o_orderstatus AS status, count(*) AS n, (sum(round(o_totalprice * 100)::BIGINT))::BIGINT AS cents, (min(o_orderkey))::BIGINT AS first_key,
              max(round(o_totalprice * 100)::BIGINT / 100.0) AS most FROM orders GROUP BY 1"""
)
def fixed_width_typed(spark, sf_dir):
    rows = snake(parse.fixed_width(order_lines(spark, sf_dir), ORDER, "P", typed_values=True))
    cents = F.sum(F.round(F.col("amount") * 100).cast("bigint")).alias("cents")
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"), cents, F.min("order_key").alias("first_key"), F.max("amount").alias("most"))


@query("SELECT o_orderstatus AS status, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents, strftime(max(o_orderdate), '%Y-%m-%d') AS last FROM orders GROUP BY 1")
def exact_decimal_and_date(spark, sf_dir):
    fields = [*ORDER[:3], Field("Order Date", 8, "YYYYMMDD"), ORDER[4]]
    rows = snake(parse.fixed_width(order_lines(spark, sf_dir), fields, typed_values=True, exact=True))
    return rows.groupBy("status").agg((F.sum("amount") * 100).cast("bigint").alias("cents"), F.date_format(F.max("order_date"), "yyyy-MM-dd").alias("last"))


@query(
    """SELECT l_orderkey AS order_key, l_linenumber AS line, round(l_quantity * 100)::BIGINT / 100.0 AS quantity, round(l_discount * 10000)::BIGINT / 10000.0 AS discount FROM lineitem"""
)
def record_type_filter(spark, sf_dir):
    mixed = order_lines(spark, sf_dir).unionAll(item_lines(spark, sf_dir))
    return snake(parse.fixed_width(mixed, ITEM, "L", typed_values=True)).select("order_key", "line", "quantity", "discount")


@query("SELECT 'P' AS record_type, substr(lpad(o_orderkey::VARCHAR, 10, '0'), 1, 4) AS filler_1, substr(lpad(o_orderkey::VARCHAR, 10, '0'), 5, 6) AS tail, o_orderstatus AS filler_3, '' AS past_end FROM orders")
def filler_columns(spark, sf_dir):
    fields = [Field("Record Type", 1), Field("Filler", 4), Field("Tail", 6), Field("Filler", 3), Field("Skip", 23), Field("Past End", 5)]
    return snake(parse.fixed_width(order_lines(spark, sf_dir), fields)).drop("skip")


DELIM = [Field("Record Type"), Field("Order Key"), Field("Line"), Field("Flag"), Field("Status")]


def pipe_lines(spark: SparkSession, sf_dir: str, ragged: bool = False) -> DataFrame:
    full = F.concat_ws("|", F.lit("LL"), "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    short = F.concat_ws("|", F.lit("LL"), "l_orderkey", "l_linenumber")
    line = F.when(F.col("l_linenumber") % 2 == 0, short).when(F.col("l_linenumber") == 5, F.concat(full, F.lit("|extra|"))).otherwise(full) if ragged else full
    return read(spark, sf_dir, "lineitem").select(line.alias("text_content"))


@query("SELECT 'LL' AS record_type, l_orderkey::VARCHAR AS order_key, l_linenumber::VARCHAR AS line, l_returnflag AS flag, l_linestatus AS status FROM lineitem")
def delimited_parse(spark, sf_dir):
    return snake(parse.delimited(pipe_lines(spark, sf_dir), DELIM, "LL"))


@query(
    """SELECT 'LL' AS record_type, l_orderkey::VARCHAR AS order_key, l_linenumber::VARCHAR AS line, CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_returnflag END AS flag,
              CASE WHEN l_linenumber % 2 = 0 THEN NULL ELSE l_linestatus END AS status FROM lineitem"""
)
def delimited_ragged(spark, sf_dir):
    return snake(parse.delimited(pipe_lines(spark, sf_dir, True), DELIM))


@query(
    """SELECT field_name, value, count(*) AS n FROM (SELECT unnest(['Flag', 'Status']) AS field_name, unnest([l_returnflag, l_linestatus]) AS value, l_linenumber AS k FROM lineitem)
       WHERE k % 2 = 1 GROUP BY 1, 2"""
)
def delimited_long(spark, sf_dir):
    rows = spark.createDataFrame([("LL", i, f.name) for i, f in enumerate(DELIM)], "record_type string, pos int, field_name string")
    got = parse.delimited_long(pipe_lines(spark, sf_dir, True), rows, names=["Flag", "Status"])
    return got.groupBy("field_name", "value").agg(F.count(F.lit(1)).alias("n"))


# Notation -----------------------------------------------------------------------------------------------------------

PIC_SQL = """CASE p_partkey % 8 WHEN 0 THEN 'X' WHEN 1 THEN 'X(' || p_size || ')' WHEN 2 THEN '9(' || p_size || ')' WHEN 3 THEN '9(' || p_size || ')v9(' || (p_partkey % 5) || ')'
    WHEN 4 THEN 'XX' WHEN 5 THEN '9' WHEN 6 THEN ' X(3) ' ELSE '9(2)V9(3)' END"""
PARSED_SQL = f"""(SELECT *, trim(notation) AS t, regexp_extract(trim(notation), '^X\\((\\d+)\\)$', 1) AS x, regexp_extract(trim(notation), '^9\\((\\d+)\\)$', 1) AS i,
    regexp_extract(trim(notation), '^9\\((\\d+)\\)v9\\((\\d+)\\)$', 1) AS d1, regexp_extract(trim(notation), '^9\\((\\d+)\\)v9\\((\\d+)\\)$', 2) AS d2
    FROM (SELECT *, {PIC_SQL} AS notation FROM part))"""
KIND_SQL = "CASE WHEN t = 'X' OR x <> '' THEN 'string' WHEN d1 <> '' THEN 'float64' WHEN i <> '' THEN 'Int64' END"
LENGTH_SQL = "CASE WHEN t = 'X' THEN 1 WHEN x <> '' THEN x::INT WHEN d1 <> '' THEN d1::INT + d2::INT WHEN i <> '' THEN i::INT END"


def notations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").withColumn("notation", F.expr(PIC_SQL))


@query(f"SELECT p_partkey, notation, {KIND_SQL} AS dtype, CASE WHEN {KIND_SQL} = 'float64' THEN d2::INT WHEN {KIND_SQL} IS NOT NULL THEN 0 END AS decimals, {LENGTH_SQL} AS length FROM {PARSED_SQL}")
def pic_parse(spark, sf_dir):
    info = notations(spark, sf_dir).withColumn("i", pic.parse_pic("notation"))
    return info.select("p_partkey", "notation", "i.dtype", "i.decimals", "i.length")


RAW_SQL = "CASE p_partkey % 3 WHEN 0 THEN lpad((p_partkey * 7)::VARCHAR, 6, '0') WHEN 1 THEN ' 42 ' ELSE '12a' END"


@query(
    f"""SELECT p_partkey, CASE WHEN coalesce({KIND_SQL}, 'string') = 'string' THEN raw END AS text, CASE WHEN {KIND_SQL} = 'Int64' THEN try_cast(trim(raw) AS BIGINT) END AS whole,
        CASE WHEN {KIND_SQL} = 'float64' THEN try_cast(trim(raw) AS BIGINT)::DOUBLE / pow(10, d2::INT) END AS number FROM (SELECT *, {RAW_SQL} AS raw FROM {PARSED_SQL})"""
)
def pic_convert(spark, sf_dir):
    rows = notations(spark, sf_dir).withColumn("raw", F.expr(RAW_SQL.replace("::VARCHAR", "::STRING")))
    return rows.withColumn("v", pic.convert_value("raw", pic.parse_pic("notation"))).select("p_partkey", "v.text", "v.whole", "v.number")


@query(
    f"""SELECT p_partkey, e IS NULL AS is_valid, e AS error_message FROM (SELECT p_partkey, CASE WHEN {KIND_SQL} IS NULL THEN 'No format information provided'
        WHEN length(raw) <> {LENGTH_SQL} THEN 'Expected length ' || ({LENGTH_SQL}) || ', got ' || length(raw) WHEN {KIND_SQL} <> 'string' AND NOT regexp_full_match(raw, '[0-9]*')
        THEN 'Value contains non-numeric characters' END AS e FROM (SELECT *, {RAW_SQL} AS raw FROM {PARSED_SQL}))"""
)
def pic_validate(spark, sf_dir):
    rows = notations(spark, sf_dir).withColumn("raw", F.expr(RAW_SQL.replace("::VARCHAR", "::STRING")))
    return rows.withColumn("v", pic.validate_value("raw", pic.parse_pic("notation"))).select("p_partkey", "v.is_valid", "v.error_message")


@query(f"SELECT dtype, count(*) AS n FROM (SELECT coalesce({KIND_SQL}, CASE WHEN p_size > 25 THEN 'given' END) AS dtype FROM {PARSED_SQL}) GROUP BY 1")
def pic_augment(spark, sf_dir):
    rows = notations(spark, sf_dir).withColumn("dtype", F.when(F.col("p_size") > 25, F.lit("given")))
    return pic.augment(rows).groupBy("dtype").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""SELECT p_brand AS name, CASE WHEN d1 <> '' THEN 'double' WHEN i <> '' AND i::INT > 18 THEN 'decimal(' || least(i::INT, 38) || ',0)' WHEN i <> '' THEN 'bigint' ELSE 'string' END AS dtype
        FROM {PARSED_SQL} QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey DESC) = 1"""
)
def dtype_map(spark, sf_dir):
    rows = notations(spark, sf_dir).groupBy("p_brand").agg(F.min_by("notation", "p_partkey").alias("first"), F.max_by("notation", "p_partkey").alias("last")).collect()  # a row for each brand
    schema = pic.dtype_map([(None, "X"), *[(r["p_brand"], r["first"]) for r in rows], *[(r["p_brand"], r["last"]) for r in rows]])
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in schema], "name string, dtype string")


# Layout tables ------------------------------------------------------------------------------------------------------

NAME_SQL = """CASE o_orderkey % 9 WHEN 0 THEN 'Record Type = H' WHEN 1 THEN 'Amount' WHEN 2 THEN 'Record Type (P=Pool)' WHEN 3 THEN 'Length of Record' WHEN 4 THEN NULL
    WHEN 5 THEN 'Record Type' WHEN 6 THEN 'record  type zz = Tail' WHEN 7 THEN 'Record Type (90)' ELSE 'Pool ID' END"""
CODE_SQL = "CASE o_orderkey % 9 WHEN 0 THEN 'H' WHEN 2 THEN 'P' WHEN 6 THEN 'ZZ' WHEN 7 THEN '90' END"
LAY_SQL = f"""(SELECT o_custkey AS file, o_orderkey AS pos, (o_orderkey % 4)::INT AS item_no, {NAME_SQL} AS field_name, {CODE_SQL} AS code, o_orderstatus AS status FROM orders)"""
GROUPED_SQL = f"""(SELECT *, (sum(reset) OVER (PARTITION BY file ORDER BY pos) - 1)::INT AS group_id FROM
    (SELECT *, CASE WHEN item_no = 1 AND coalesce(lag(item_no) OVER (PARTITION BY file ORDER BY pos), 1) <> 1 THEN 1 ELSE 0 END AS reset FROM {LAY_SQL}))"""
FIRST_SQL = f"(SELECT *, first(code IGNORE NULLS) OVER (PARTITION BY file, group_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS record_type FROM {GROUPED_SQL})"
MENTION_SQL = "CASE WHEN lower(trim(field_name)) LIKE '%record type%' AND lower(trim(field_name)) <> 'record type' THEN 1 ELSE 0 END"


def layout_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders").withColumn("field_name", F.expr(NAME_SQL))
    return o.select(F.col("o_custkey").alias("file"), F.col("o_orderkey").alias("pos"), (F.col("o_orderkey") % 4).cast("int").alias("item_no"), "field_name", F.col("o_orderstatus").alias("status"))


def grouped_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout.item_groups(layout_rows(spark, sf_dir)).withColumn("record_type", names.record_type_code("field_name"))


@query(f"SELECT pos, code FROM {LAY_SQL}")
def record_type_code(spark, sf_dir):
    return layout_rows(spark, sf_dir).select("pos", names.record_type_code("field_name").alias("code"))


@query(f"SELECT file, pos, group_id FROM {GROUPED_SQL}")
def item_groups(spark, sf_dir):
    return layout.item_groups(layout_rows(spark, sf_dir)).select("file", "pos", "group_id")


@query(f"SELECT file, pos, group_id, record_type FROM {FIRST_SQL}")
def propagate_type(spark, sf_dir):
    return layout.propagate_types(grouped_rows(spark, sf_dir)).select("file", "pos", "group_id", "record_type")


@query(
    f"""SELECT file, group_id, coalesce(string_agg(DISTINCT code, ',' ORDER BY code), '') AS record_types, count(DISTINCT code) AS n_types, count(*) AS n_rows FROM {GROUPED_SQL} GROUP BY 1, 2"""
)
def group_conflicts(spark, sf_dir):
    return layout.group_conflicts(grouped_rows(spark, sf_dir))


@query(
    f"""SELECT file, pos, group_id FROM (SELECT *, max(m) OVER (PARTITION BY file, group_id) AS g, max(m) OVER (PARTITION BY file) AS f FROM (SELECT *, {MENTION_SQL} AS m FROM {GROUPED_SQL}))
        WHERE g = 1 OR f = 0"""
)
def group_retention(spark, sf_dir):
    return layout.retain_groups(grouped_rows(spark, sf_dir), ["field_name"]).select("file", "pos", "group_id")


@query(f"SELECT pos, field_name FROM {LAY_SQL} WHERE field_name IS DISTINCT FROM 'Length of Record'")
def drop_length_rows(spark, sf_dir):
    return layout.drop_length_rows(layout_rows(spark, sf_dir)).select("pos", "field_name")


@query(f"SELECT pos FROM {LAY_SQL} WHERE field_name IS NOT NULL OR nullif(status, 'F') IS NOT NULL")
def drop_empty_rows(spark, sf_dir):
    rows = layout_rows(spark, sf_dir).withColumn("status", F.nullif("status", F.lit("F")))
    return layout.drop_empty_rows(rows, ["field_name", "status"]).select("pos")


BIJECTION_SQL = f"""SELECT g.file, n_groups, coalesce(groups_per_type, 0) AS groups_per_type, types_per_group, n_groups = 1 OR (coalesce(groups_per_type, 0) = 1 AND types_per_group = 1) AS redundant FROM
        (SELECT file, count(*) AS n_groups, max(t) AS types_per_group FROM (SELECT file, group_id, count(DISTINCT code) AS t FROM {GROUPED_SQL} GROUP BY 1, 2) GROUP BY 1) g LEFT JOIN
        (SELECT file, max(n) AS groups_per_type FROM (SELECT file, code, count(DISTINCT group_id) AS n FROM {GROUPED_SQL} WHERE code IS NOT NULL GROUP BY 1, 2) GROUP BY 1) t ON g.file = t.file"""


@query(BIJECTION_SQL)
def group_type_bijection(spark, sf_dir):
    return layout.group_type_bijection(grouped_rows(spark, sf_dir))


@query(
    f"""SELECT file, pos, group_id, record_type FROM (SELECT *, first(code IGNORE NULLS) OVER (PARTITION BY file, group_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS record_type
        FROM (SELECT *, max(m) OVER (PARTITION BY file, group_id) AS g, max(m) OVER (PARTITION BY file) AS f FROM (SELECT *, {MENTION_SQL} AS m FROM {GROUPED_SQL}
        WHERE field_name IS DISTINCT FROM 'Length of Record' AND field_name IS NOT NULL)) WHERE g = 1 OR f = 0)"""
)
def layout_clean(spark, sf_dir):
    rows = layout_rows(spark, sf_dir).withColumn("item", F.concat(F.lit("P"), F.col("item_no").cast("string"))).drop("item_no")
    junk = rows.limit(0).unionByName(rows.filter("pos % 50 = 0").withColumn("item", F.lit("Col1")))  # rows that a broken table adds
    return layout.clean_layout(rows.unionByName(junk), ["field_name"]).select("file", "pos", "group_id", "record_type")


@query(f"SELECT group_id, code AS record_type, count(*) AS n FROM {GROUPED_SQL} GROUP BY 1, 2")
def value_counts(spark, sf_dir):
    return report.value_counts(grouped_rows(spark, sf_dir), ["group_id", "record_type"])


@query(f"SELECT file, pos FROM {LAY_SQL} QUALIFY row_number() OVER (PARTITION BY file ORDER BY pos) <= 5")
def first_rows(spark, sf_dir):
    return report.first_rows(layout_rows(spark, sf_dir), ["file"], ["pos"], 5).select("file", "pos")


@query(f"SELECT pos, CASE WHEN redundant THEN NULL ELSE group_id END AS group_id FROM {GROUPED_SQL} JOIN ({BIJECTION_SQL}) USING (file)")
def drop_group_ids(spark, sf_dir):
    return layout.without_redundant_groups(grouped_rows(spark, sf_dir)).select("pos", "group_id")


VERSIONS_SQL = """(SELECT r_regionkey AS region, 'old' AS version, NULL::DATE AS a, (DATE '1997-01-31' + to_months(r_regionkey::INT))::DATE AS b FROM region UNION ALL
    SELECT r_regionkey, 'mid', (DATE '1997-01-31' + to_months(r_regionkey::INT) + INTERVAL 1 DAY)::DATE, DATE '1999-06-30' FROM region UNION ALL SELECT r_regionkey, 'new', DATE '1999-06-01', NULL FROM region)"""


@query(
    f"""SELECT o_orderkey, arg_max(version, coalesce(a, DATE '0001-01-01')) AS version, count(version) > 1 AS overlap FROM (SELECT o_orderkey, (o_custkey % 5)::INT AS k, date_trunc('month', o_orderdate)::DATE AS d FROM orders) o
        LEFT JOIN {VERSIONS_SQL} v ON v.region = o.k AND (a IS NULL OR a <= d) AND (b IS NULL OR d <= b) GROUP BY 1"""
)
def layout_asof_join(spark, sf_dir):
    files = read(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_custkey") % 5).cast("int").alias("series"), F.trunc("o_orderdate", "month").alias("day"))
    r = read(spark, sf_dir, "region").select(F.col("r_regionkey").alias("series"))
    cut = F.add_months(F.lit("1997-01-31").cast("date"), F.col("series"))
    v = r.select("series", F.lit("old").alias("version"), F.lit(None).cast("date").alias("version_from"), cut.alias("version_to"))
    v = v.unionAll(r.select("series", F.lit("mid"), F.date_add(cut, 1), F.lit("1999-06-30").cast("date"))).unionAll(r.select("series", F.lit("new"), F.lit("1999-06-01").cast("date"), F.lit(None).cast("date")))
    return layout.version_for(files, v).select("o_orderkey", "version", "overlap")


@query("SELECT p_name AS field_name, NULL AS data_element, p_size AS length FROM part UNION ALL SELECT NULL, s_name, NULL FROM supplier")
def layout_union(spark, sf_dir):
    a = read(spark, sf_dir, "part").select(F.col("p_name").alias("field_name"), F.col("p_size").alias("length"))
    b = read(spark, sf_dir, "supplier").select(F.col("s_name").alias("data_element"))
    return layouts.union_layouts([a, b])


@query("SELECT coalesce(CASE WHEN p_size % 2 = 0 THEN p_name END, p_type) AS field_name, coalesce(CASE WHEN p_size % 3 = 0 THEN p_size END, p_partkey::INT) AS length, p_brand AS notation FROM part")
def layout_coalesce(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    even, third = F.col("p_size") % 2 == 0, F.col("p_size") % 3 == 0
    table = p.select(F.when(even, F.col("p_name")).alias("Data Item"), F.col("p_type").alias("Data Element"), F.when(third, F.col("p_size").cast("string")).alias("Length"), F.col("p_partkey").cast("string").alias("Max Length"), F.col("p_brand").alias("Format"))
    return layouts.canonical(table).select("field_name", "length", "notation")


@query(
    """SELECT b AS begin, b + 1 AS "end", count(*) FILTER (WHERE v = 'F') AS "has_F", count(*) FILTER (WHERE v = 'O') AS "has_O", count(*) FILTER (WHERE v = 'P') AS "has_P", arg_max(k::VARCHAR, k) AS field_name
       FROM (SELECT (o_custkey % 50)::INT AS b, o_orderstatus AS v, o_orderkey AS k FROM orders) GROUP BY 1, 2"""
)
def layout_reconcile(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    b = (F.col("o_custkey") % 50).cast("int")
    rows = o.select(b.alias("begin"), (b + 1).alias("end"), F.col("o_orderstatus").alias("version"), F.col("o_orderkey").alias("version_order"), F.col("o_orderkey").cast("string").alias("field_name"))
    return layout.reconcile(rows, ["F", "O", "P"])


@query(
    """SELECT s AS series, count(*) AS n_rows, count(DISTINCT o_orderstatus) AS n_types, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS record_types,
              CASE WHEN s % 3 = 0 THEN 'Item,Max Length,Format' WHEN s % 3 = 1 THEN 'Item,Begin,End' ELSE 'Item' END AS column_names, CASE s % 3 WHEN 0 THEN 'DELIMITED' WHEN 1 THEN 'FIXED_WIDTH' ELSE 'UNKNOWN' END AS format
       FROM (SELECT *, (o_custkey % 100)::INT AS s FROM orders) GROUP BY s"""
)
def layout_profile(spark, sf_dir):
    s = (F.col("o_custkey") % 100).cast("int")
    own = lambda k, name: F.when(s % 3 == k, F.col("o_orderkey").cast("string")).alias(name)
    rows = read(spark, sf_dir, "orders").select(s.alias("series"), F.col("o_orderstatus").alias("record_type"), F.col("o_orderkey").cast("string").alias("Item"), own(0, "Max Length"), own(0, "Format"), own(1, "Begin"), own(1, "End"))
    return layout.layout_profile(rows)


@query("SELECT p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey % 7, p_partkey) AS ordinal FROM (SELECT p_partkey, p_brand FROM part)")
def layout_sort(spark, sf_dir):
    label = F.concat(F.chr(F.lit(65) + F.col("p_partkey") % 7), F.lit("-"), F.col("p_partkey").cast("string"))
    rows = read(spark, sf_dir, "part").select("p_partkey", "p_brand", label.alias("item"))
    return layout.item_order(rows, ["p_brand"]).select("p_partkey", "ordinal")


@query("SELECT p_partkey, coalesce(sum(p_size) OVER (PARTITION BY p_brand ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS field_offset FROM part")
def layout_offsets(spark, sf_dir):
    return layout.with_offsets(read(spark, sf_dir, "part"), ["p_brand"], "p_partkey", "p_size").select("p_partkey", F.col("offset").alias("field_offset"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') END AS a,
              CASE o_orderkey % 4 WHEN 0 THEN '2099-12-31' WHEN 1 THEN strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH, '%Y-%m-%d') END AS b FROM orders"""
)
def layout_dates(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    m = lambda d: F.date_format(d, "MMM yyyy")
    k = F.col("o_orderkey") % 4
    name = F.concat(F.lit("layout (x) V1.0 ("), F.when(k == 0, F.concat(m("o_orderdate"), F.lit(" - Present"))).when(k == 1, F.concat(m("o_orderdate"), F.lit(" - "), m(F.add_months(F.trunc("o_orderdate", "month"), 1)))).when(k == 2, F.lit("MBS")).otherwise(F.lit("no - date")), F.lit(").csv"))
    a, b = dates.validity_dates(name)
    return o.select("o_orderkey", day(a).alias("a"), day(b).alias("b"))


# Names --------------------------------------------------------------------------------------------------------------

RAWNAME_SQL = """CASE p_partkey % 6 WHEN 0 THEN p_name || ' (' || p_brand || ')' WHEN 1 THEN '% of ' || p_type || '/' || p_name WHEN 2 THEN 'Filler ' || p_size WHEN 3 THEN 'Record Type = ' || p_brand
    WHEN 4 THEN p_size || '+ Days-' || p_type || ' *' ELSE ' ' || p_name || ', ' || p_type || ' ' END"""
STD_SQL = """CASE WHEN lower(n) LIKE '%filler%' THEN 'Filler' WHEN n LIKE 'Record Type%' THEN 'Record Type' ELSE trim(regexp_replace(CASE WHEN regexp_matches(s, '^[0-9]') THEN 'Field_' || s ELSE s END, '_+', '_', 'g'), '_') END"""
SIGNS_SQL = "replace(replace(replace(replace(replace(replace(replace(replace(regexp_replace(n, '\\([^)]*\\)', '', 'g'), '%', 'Percent'), '/', '_or_'), '=', '_equals_'), '-', '_'), '+', '_Plus'), '*', ''), ',', ''), ' ', '_')"
STDNAMES_SQL = f"(SELECT *, {STD_SQL} AS std_name FROM (SELECT *, {SIGNS_SQL} AS s FROM (SELECT *, {RAWNAME_SQL} AS n FROM part)))"


def raw_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").withColumn("n", F.expr(RAWNAME_SQL))


@query(f"SELECT p_partkey, std_name FROM {STDNAMES_SQL}")
def name_standardize(spark, sf_dir):
    return raw_names(spark, sf_dir).select("p_partkey", names.standard_name("n").alias("std_name"))


@query("SELECT name, count(*) AS n FROM (SELECT trim(p_name) AS name FROM part UNION ALL SELECT trim(p_type) FROM part) WHERE name IS NOT NULL GROUP BY 1")
def name_counts(spark, sf_dir):
    return frequency.name_counts(read(spark, sf_dir, "part"), ["p_name", "p_type"])


@query(f"SELECT name, n, std_name, (sum(n) OVER (PARTITION BY std_name))::BIGINT AS std_n, name <> std_name AS changed FROM (SELECT n AS name, any_value(std_name) AS std_name, count(*) AS n FROM (SELECT trim(n) AS n, trim(std_name) AS std_name FROM {STDNAMES_SQL}) GROUP BY 1)")
def name_table(spark, sf_dir):
    return frequency.name_table(frequency.name_counts(raw_names(spark, sf_dir), ["n"]))


# Dates --------------------------------------------------------------------------------------------------------------

DATETEXT_SQL = """CASE o_orderkey % 9 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d') WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y') WHEN 3 THEN strftime(o_orderdate, '%m-%d-%Y')
    WHEN 4 THEN strftime(o_orderdate, '%Y%m%d') WHEN 5 THEN strftime(o_orderdate, '%Y%m') WHEN 6 THEN strftime(o_orderdate, '%Y%m%d%H%M%S') WHEN 7 THEN '2024-02-30' ELSE 'n/a' END"""


@query("SELECT o_orderkey, CASE o_orderkey % 9 WHEN 0 THEN '%Y-%m-%d' WHEN 1 THEN '%Y/%m/%d' WHEN 2 THEN '%m/%d/%Y' WHEN 3 THEN '%m-%d-%Y' WHEN 4 THEN '%Y%m%d' WHEN 5 THEN '%Y%m' WHEN 6 THEN '%Y%m%d%H%M%S' END AS fmt FROM orders")
def date_format_detect(spark, sf_dir):
    k, d = F.col("o_orderkey") % 9, "o_orderdate"
    value = F.lit("n/a")
    for i, (_, _, java) in enumerate(dates.FORMATS):
        value = F.when(k == i, F.date_format(d, java)).otherwise(value)
    value = F.when(k == 7, F.lit("2024-02-30")).otherwise(value)
    return read(spark, sf_dir, "orders").select("o_orderkey", dates.date_format_of(value).alias("fmt"))


@query(
    """SELECT o_orderkey, strftime(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH - INTERVAL 1 DAY, '%Y%m%d') AS month_end, strftime(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY, '%Y%m') AS quarter_end,
              strftime(date_trunc('year', o_orderdate), '%Y-%m-%d') AS year_start FROM orders"""
)
def period_suffix(spark, sf_dir):
    d = "o_orderdate"
    return read(spark, sf_dir, "orders").select("o_orderkey", dates.period_suffix(d, "%Y%m%d", "monthly").alias("month_end"), dates.period_suffix(d, "%Y%m", "quarterly").alias("quarter_end"), dates.period_suffix(d, "%Y-%m-%d", "yearly", True).alias("year_start"))


CATALOG_SQL = """(SELECT 's' || c AS series, d AS min_date, CASE c % 3 WHEN 0 THEN 'monthly' WHEN 1 THEN 'quarterly' ELSE 'yearly' END AS frequency, CASE c % 3 WHEN 0 THEN 1 WHEN 1 THEN 3 ELSE 12 END AS months,
    CASE c % 3 WHEN 0 THEN 'month' WHEN 1 THEN 'quarter' ELSE 'year' END AS unit FROM (SELECT o_custkey AS c, date_trunc('month', min(o_orderdate))::DATE AS d FROM orders GROUP BY 1))"""
EXPECTED_SQL = f"""(SELECT series, (row_number() OVER (PARTITION BY series ORDER BY d) - 1)::INT AS step, d, series || '_' || strftime(date_trunc(unit, d) + to_months(months) - INTERVAL 1 DAY, '%Y%m') || '.zip' AS file_name
    FROM (SELECT *, unnest(generate_series(min_date::TIMESTAMP, TIMESTAMP '2001-06-30', to_months(months))) AS d FROM {CATALOG_SQL}))"""
LINKED_SQL = "(SELECT DISTINCT 's' || o_custkey || '_' || strftime(o_orderdate, '%Y%m') || '.zip' AS file_name FROM orders)"


def series_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.trunc(F.min("o_orderdate"), "month").alias("min_date"))
    k = F.col("o_custkey") % 3
    frequency_ = F.when(k == 0, F.lit("monthly")).when(k == 1, F.lit("quarterly")).otherwise(F.lit("yearly"))
    return c.select(F.concat(F.lit("s"), F.col("o_custkey").cast("string")).alias("series"), "min_date", F.lit(None).cast("date").alias("max_date"), F.lit("zip").alias("extension"), F.lit("%Y%m").alias("date_format"), frequency_.alias("frequency"), F.lit("").alias("description"))


def expected_with_links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    have = read(spark, sf_dir, "orders").select(F.concat(F.lit("/data/s"), F.col("o_custkey").cast("string"), F.lit("_"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".zip")).alias("href"))
    return coverage.expected_files(series_catalog(spark, sf_dir), F.lit("2001-06-30").cast("date")), have


@query(f"SELECT series, step, file_name FROM {EXPECTED_SQL}")
def expected_files(spark, sf_dir):
    return expected_with_links(spark, sf_dir)[0].select("series", "step", "file_name")


@query(f"SELECT series, step, file_name FROM {EXPECTED_SQL} WHERE file_name NOT IN (SELECT file_name FROM {LINKED_SQL})")
def missing_files(spark, sf_dir):
    return coverage.missing_files(*expected_with_links(spark, sf_dir)).select("series", "step", "file_name")


MISS_SQL = f"""(SELECT *, sum(CASE WHEN hit THEN 0 ELSE 1 END) OVER (PARTITION BY series, run ORDER BY step) AS misses FROM (SELECT *, sum(CASE WHEN hit THEN 1 ELSE 0 END) OVER (PARTITION BY series ORDER BY step) AS run
    FROM (SELECT e.*, l.file_name IS NOT NULL AS hit FROM {EXPECTED_SQL} e LEFT JOIN {LINKED_SQL} l USING (file_name))))"""


@query(f"SELECT series, step, hit, misses::BIGINT AS misses FROM (SELECT *, min(CASE WHEN misses >= 6 THEN step END) OVER (PARTITION BY series) AS stop FROM {MISS_SQL}) WHERE stop IS NULL OR step <= stop")
def miss_runs(spark, sf_dir):
    expected, have = expected_with_links(spark, sf_dir)
    linked = have.select(F.element_at(F.split("href", "/"), -1).alias("file_name"), F.lit(True).alias("linked")).distinct()
    files = expected.join(linked, "file_name", "left").withColumn("hit", F.col("linked").isNotNull())
    return coverage.miss_runs(files, 6).select("series", "step", "hit", "misses")


RANGES_SQL = """(SELECT DISTINCT o_custkey AS series, date_trunc('month', o_orderdate)::DATE AS a, CASE WHEN o_orderkey % 40 = 0 THEN DATE '2001-08-01' ELSE (date_trunc('month', o_orderdate) + to_months((o_orderkey % 3)::INT))::DATE END AS b FROM orders)"""
COVERED_SQL = f"(SELECT DISTINCT series, unnest(generate_series(a::TIMESTAMP, date_trunc('month', b), INTERVAL 1 MONTH))::DATE AS month FROM {RANGES_SQL})"
WANTED_SQL = f"(SELECT series, unnest(generate_series(min(a)::TIMESTAMP, date_trunc('month', max(b)), INTERVAL 1 MONTH))::DATE AS month FROM {RANGES_SQL} GROUP BY 1)"
GAPS_SQL = f"""(SELECT series, min(month) AS gap_start, max(month) AS gap_end, count(*) AS n_months FROM (SELECT series, month, year(month) * 12 + month(month) - row_number() OVER (PARTITION BY series ORDER BY month) AS k
    FROM (SELECT * FROM {WANTED_SQL} EXCEPT SELECT * FROM {COVERED_SQL})) GROUP BY series, k)"""


def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    start = F.trunc("o_orderdate", "month")
    end = F.when(F.col("o_orderkey") % 40 == 0, F.lit(dates.OPEN_END).cast("date")).otherwise(F.add_months(start, (F.col("o_orderkey") % 3).cast("int")))
    return o.select(F.col("o_custkey").alias("series"), start.alias("start"), end.alias("end"))



@query(f"SELECT series, strftime(gap_start, '%Y-%m-%d') AS gap_start, strftime(gap_end, '%Y-%m-%d') AS gap_end, n_months FROM {GAPS_SQL}")
def gap_periods(spark, sf_dir):
    r = ranges(spark, sf_dir).withColumn("end", dates.clamp_end("end", F.lit("2001-08-01").cast("date")))
    missing = coverage.missing_months(coverage.expected_months(r), coverage.covered_months(r))
    return coverage.gap_periods(missing).select("series", day("gap_start").alias("gap_start"), day("gap_end").alias("gap_end"), "n_months")


@query(
    f"""SELECT b.series, strftime(min_start, '%Y-%m-%d') AS min_start, strftime(max_end, '%Y-%m-%d') AS max_end, n_ranges, expected, expected - coalesce(missing, 0) AS covered, coalesce(missing, 0)::BIGINT AS missing,
        round((expected - coalesce(missing, 0)) * 100.0 / expected, 1)::DOUBLE AS coverage_pct, coalesce(missing, 0) > 0 AS has_gaps, coalesce(gaps, 'None') AS gaps FROM
        (SELECT series, min(a) AS min_start, max(b) AS max_end, count(*) AS n_ranges FROM {RANGES_SQL} GROUP BY 1) b JOIN (SELECT series, count(*) AS expected FROM {WANTED_SQL} GROUP BY 1) e USING (series) LEFT JOIN
        (SELECT series, sum(n_months)::BIGINT AS missing, string_agg(strftime(gap_start, '%Y-%m') || CASE WHEN gap_start = gap_end THEN '' ELSE ' to ' || strftime(gap_end, '%Y-%m') END, '; ' ORDER BY gap_start) AS gaps FROM {GAPS_SQL} GROUP BY 1) g USING (series)"""
)
def month_coverage(spark, sf_dir):
    out = coverage.coverage(ranges(spark, sf_dir), F.lit("2001-08-01").cast("date"))
    return out.withColumns({"min_start": day("min_start"), "max_end": day("max_end")})


@query(f"SELECT series, count(*) AS attempted, count(*) FILTER (WHERE hit) AS obtained, count(*) FILTER (WHERE NOT hit) AS missed, GROUPING(series)::INT AS level FROM {MISS_SQL} GROUP BY ROLLUP (series)")
def manifest_rollup(spark, sf_dir):
    expected, have = expected_with_links(spark, sf_dir)
    linked = have.select(F.element_at(F.split("href", "/"), -1).alias("file_name"), F.lit(True).alias("linked")).distinct()
    return report.manifest_counts(expected.join(linked, "file_name", "left").withColumn("hit", F.col("linked").isNotNull()))


# Formats ------------------------------------------------------------------------------------------------------------

FLAGS = ("max_length", "begin_end", "fmt", "description", "definition", "remarks", "element", "item", "end_only")
FLAGS_SQL = "(SELECT p_partkey, " + ", ".join(f"(p_partkey // {2**i}) % 2 = 1 AS {f}" for i, f in enumerate(FLAGS)) + " FROM part)"


def flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", *[(F.expr(f"(p_partkey div {2**i}) % 2") == 1).alias(f) for i, f in enumerate(FLAGS)])


@query(f"SELECT p_partkey, CASE WHEN max_length AND fmt THEN 'DELIMITED' WHEN begin_end THEN 'FIXED_WIDTH' ELSE 'UNKNOWN' END AS format FROM {FLAGS_SQL}")
def format_detect(spark, sf_dir):
    return flags(spark, sf_dir).select("p_partkey", profile.format_rule(F.col("max_length"), F.col("fmt"), F.col("begin_end"), F.col("begin_end") | F.col("end_only")).alias("format"))


SCORE_SQL = f"""(SELECT *, CASE WHEN max_length THEN 3 ELSE 0 END - CASE WHEN begin_end THEN 3 ELSE 0 END + CASE WHEN fmt THEN 2 ELSE 0 END + CASE WHEN description AND definition THEN 1 ELSE 0 END
    - CASE WHEN remarks AND NOT (description OR definition) THEN 1 ELSE 0 END + CASE WHEN element THEN 1 WHEN item THEN -1 ELSE 0 END AS score FROM {FLAGS_SQL})"""


@query(
    f"""SELECT p_partkey, score, CASE WHEN score >= 3 THEN 'DELIMITED' WHEN score <= -2 THEN 'FIXED-WIDTH' ELSE 'UNCERTAIN' END AS predicted, concat_ws('; ', CASE WHEN max_length THEN 'Max Length column' END,
        CASE WHEN begin_end THEN 'Begin/End columns' END, CASE WHEN fmt THEN 'Format column' END, CASE WHEN description AND definition THEN 'Description/Definition columns' END,
        CASE WHEN remarks AND NOT (description OR definition) THEN 'Remarks column only' END, CASE WHEN element THEN 'Data Element naming' END, CASE WHEN NOT element AND item THEN 'Data Item naming' END) AS indicators FROM {SCORE_SQL}"""
)
def format_score(spark, sf_dir):
    score, predicted, indicators = profile.format_score(*[F.col(f) for f in FLAGS[:8]])
    return flags(spark, sf_dir).select("p_partkey", score.alias("score"), predicted.alias("predicted"), indicators.alias("indicators"))


HINTTEXT_SQL = "text || CASE doc_id % 4 WHEN 0 THEN ' Comma separated' WHEN 1 THEN ' DELIMITED' WHEN 2 THEN ' fixed-width' ELSE '' END"


@query(
    f"""SELECT hints, count(*) AS n FROM (SELECT CASE WHEN h = '' THEN 'None' ELSE h END AS hints FROM (SELECT concat_ws('; ', CASE WHEN lower(t) LIKE '%delimit%' THEN '''Format'' mentions delimiter' END,
        CASE WHEN lower(t) LIKE '%fixed%' AND lower(t) LIKE '%width%' THEN '''Format'' mentions fixed width' END, CASE WHEN lower(t) LIKE '%pipe%' OR t LIKE '%|%' THEN '''Format'' mentions pipe delimiter' END,
        CASE WHEN lower(t) LIKE '%comma%' AND lower(t) LIKE '%separat%' THEN '''Format'' mentions comma separator' END) AS h FROM (SELECT {HINTTEXT_SQL} AS t FROM documents))) GROUP BY 1"""
)
def delimiter_hints(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select(F.expr(HINTTEXT_SQL).alias("t"))
    return docs.groupBy(profile.delimiter_hints(F.col("t"), "Format").alias("hints")).agg(F.count(F.lit(1)).alias("n"))


# Links --------------------------------------------------------------------------------------------------------------

LINKS_SQL = """(SELECT page_id, unnest(range(len(h)))::INT AS link_no, unnest(h) AS href, trim(regexp_replace(unnest(t), '<[^>]*>', '', 'g')) AS link_text FROM (SELECT page_id,
    regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 1) AS h, regexp_extract_all(html, '(?is)<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["''][^>]*>(.*?)</a>', 2) AS t FROM pages))"""


@query(f"SELECT * FROM {LINKS_SQL}")
def page_links(spark, sf_dir):
    return links.page_links(read(spark, sf_dir, "pages").select("page_id", "html"))


@query(f"SELECT page_id, link_no, href FROM {LINKS_SQL} WHERE lower(href) LIKE '%er' AND href LIKE '%e%' AND link_text NOT LIKE '%ing%'")
def pdf_links(spark, sf_dir):
    found = links.page_links(read(spark, sf_dir, "pages").select("page_id", "html"))
    return links.without_texts(links.naming(links.with_suffix(found, "ER"), "e"), ["ing"]).select("page_id", "link_no", "href")


@query(f"""SELECT page_id, link_no, 'x_' || regexp_replace(link_text, '[\\\\/*?:"<>|]', '_', 'g') || 'on' AS file_name, CASE WHEN href LIKE 'http%' THEN href ELSE 'https://host' || href END AS url FROM {LINKS_SQL} WHERE lower(href) LIKE '%on'""")
def link_names(spark, sf_dir):
    return links.document_manifest(read(spark, sf_dir, "pages").select("page_id", "html"), "x", "https://host", "on").select("page_id", "link_no", "file_name", "url")


# Jobs ---------------------------------------------------------------------------------------------------------------


def drop_files(spark: SparkSession, sf_dir: str, name: str, rows: Column | None = None) -> str:
    """Order lines as text files ord_<year><month>.txt in a shared folder."""
    path = scratch(spark, name)
    period = F.date_format("o_orderdate", "yyyyMM").alias("period")
    rows_ = order_lines(spark, sf_dir, "o_orderdate").select(period, F.col("text_content").alias("value"))
    (rows_ if rows is None else rows_.filter(rows)).repartition("period").write.mode("overwrite").partitionBy("period").text(path)
    return path


#: Lines of a month's archive, at most about.
ARCHIVE_LINES = 200_000
LINE_SQL = "'P' || lpad(o_orderkey::VARCHAR, 10, '0') || rpad(o_orderstatus, 3, ' ') || strftime(o_orderdate, '%Y%m%d') || lpad(round(o_totalprice * 100)::BIGINT::VARCHAR, 15, '0')"


@query(f"SELECT {LINE_SQL} AS text_content FROM orders")
def stage_text(spark, sf_dir):
    return lines.read_text(spark, drop_files(spark, sf_dir, "text")).select("text_content")


@query(f"SELECT 'ord_' || strftime(o_orderdate, '%Y%m') || '.zip' AS file, 'A.TXT' AS member, count(*) AS n, max({LINE_SQL}) AS last FROM orders GROUP BY 1")
def stage_zip(spark, sf_dir):
    def packed(pdf: pd.DataFrame) -> pd.DataFrame:
        raw = io.BytesIO()
        with zipfile.ZipFile(raw, "w") as z:
            z.writestr("A.TXT", "".join(f"{x}\r\n" for x in pdf["text_content"]))
            z.writestr("readme.md", "not records")
        return pd.DataFrame({"path": [f"/drops/ord_{pdf['period'].iloc[0]}.zip"], "content": [raw.getvalue()]})

    rows = order_lines(spark, sf_dir, "o_orderkey", "o_orderdate").withColumn("period", F.date_format("o_orderdate", "yyyyMM"))
    parts = max(1, -(-rows.count() // ARCHIVE_LINES))  # a month is so many archives of one name that none grows with the table
    dealt = rows.select("period", F.pmod(F.xxhash64("o_orderkey"), F.lit(parts)).alias("part"), "text_content")
    archives = dealt.groupBy("period", "part").applyInPandas(packed, "path string, content binary")
    return lines.unzip(archives).filter(F.col("error").isNull()).groupBy("file", "member").agg(F.count(F.lit(1)).alias("n"), F.max("text_content").alias("last"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN p_name || ' é' ELSE p_name || ' é' END AS line FROM part")
def encoding_fallback(spark, sf_dir):
    p = read(spark, sf_dir, "part")
    raw = F.when(F.col("p_partkey") % 2 == 0, F.encode(F.concat("p_name", F.lit(" é")), "UTF-8")).otherwise(F.encode(F.concat("p_name", F.lit(" é")), "ISO-8859-1"))
    return p.select("p_partkey", text.decode_line(raw).alias("line"))


LEDGER_SQL = "(SELECT 's' || (o_custkey % 20) AS series, o_orderkey::VARCHAR AS file, o_orderpriority AS record_type, CASE o_orderkey % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'skipped' ELSE 'success' END AS status, o_orderkey AS n FROM orders)"


def ledger_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey") % 5
    status = F.when(k == 0, F.lit("failed")).when(k == 1, F.lit("skipped")).otherwise(F.lit("success"))
    series = F.concat(F.lit("s"), (F.col("o_custkey") % 20).cast("string"))
    return read(spark, sf_dir, "orders").select(series.alias("series"), F.col("o_orderkey").cast("string").alias("file"), F.col("o_orderpriority").alias("record_type"), status.alias("status"), F.col("o_orderkey").alias("n"))


@query(
    f"""SELECT series, successful, failed, skipped, total, successful + failed AS attempted, CASE WHEN successful + failed > 0 THEN (successful * 100.0 / (successful + failed))::DOUBLE ELSE 0.0 END AS success_rate FROM (SELECT series,
        count(*) FILTER (WHERE status = 'success') AS successful, count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'skipped') AS skipped, count(*) AS total FROM {LEDGER_SQL} GROUP BY 1)"""
)
def ledger_rollup(spark, sf_dir):
    return ledger.run_summary(ledger_rows(spark, sf_dir)).withColumn("success_rate", F.col("success_rate").cast("double"))


@query(f"SELECT series, t AS record_type, sum(n)::BIGINT AS records, GROUPING(series, t)::INT AS level FROM (SELECT *, nullif(record_type, '5-LOW') AS t FROM {LEDGER_SQL} WHERE status = 'success') GROUP BY ROLLUP (series, t)")
def records_by_type(spark, sf_dir):
    return ledger.records_by_type(ledger_rows(spark, sf_dir).withColumn("record_type", F.nullif("record_type", F.lit("5-LOW"))))


@query(f"SELECT series, file FROM {LEDGER_SQL} WHERE status <> 'success'")
def skip_existing(spark, sf_dir):
    rows = ledger_rows(spark, sf_dir)
    return ledger.to_do(rows.select("series", "file"), rows, ["series", "file"])


@query(f"SELECT s.series, s.file, t.record_type FROM (SELECT DISTINCT series, file FROM {LEDGER_SQL}) s JOIN (SELECT DISTINCT series, record_type FROM {LEDGER_SQL} WHERE record_type IN ('1-URGENT', '2-HIGH')) t USING (series)")
def work_list(spark, sf_dir):
    rows = ledger_rows(spark, sf_dir)
    return ledger.work_list(rows.select("series", "file"), rows.select("series", "record_type").distinct(), ["1-URGENT", "2-HIGH", "none"]).select("series", "file", "record_type")


@query("SELECT 'P' AS record_type, strftime(o_orderdate, '%Y%m') AS period, count(*) AS n, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents FROM orders GROUP BY 2")
def pipeline_series(spark, sf_dir):
    staged, clean = scratch(spark, "staged"), scratch(spark, "clean")
    rows = order_lines(spark, sf_dir, "o_orderdate").select(F.concat(F.lit("ord_"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".txt")).alias("file"), "text_content")
    lines.stage(rows, staged, "ord")
    jobs.transform_series(spark, staged, clean, "ord", {"P": ORDER}, jobs.FIXED_WIDTH, typed_values=True)
    got = jobs.read_clean(spark, clean, "ord", "P")
    cents = F.sum(F.round(F.col("Amount") * 100).cast("bigint")).alias("cents")
    return got.groupBy(F.col("Record Type").alias("record_type"), "period").agg(F.count(F.lit(1)).alias("n"), cents)


@query("SELECT o_orderstatus AS status, count(*) AS n, count(DISTINCT o_orderkey) AS n_keys FROM orders GROUP BY 1")
def incremental_ingest(spark, sf_dir):
    path, target, checkpoint = (scratch(spark, n) for n in ("drops", "ingested", "checkpoint"))
    for year in (False, True):  # what has come by the first run is not read again by the second
        early = F.col("period") < "1998"
        rows = order_lines(spark, sf_dir, "o_orderdate").select(F.date_format("o_orderdate", "yyyyMM").alias("period"), F.col("text_content").alias("value"))
        rows.filter(~early if year else early).select("value").write.mode("append").text(path)
        ingest(spark, path, target, checkpoint, "part", [Field("Record_Type", 1), *[Field(f.name.replace(" ", "_"), f.length) for f in ORDER[1:]]], "P", glob="part-*")
    got = spark.read.parquet(target)
    return got.groupBy(F.col("Status").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("Order_Key").alias("n_keys"))


# Layout files, versions and whole series ----------------------------------------------------------------------------


def layout_folders(spark: SparkSession, sf_dir: str, together: bool = False) -> dict[str, str]:
    """Layouts of two series as CSV files with headers of their own, from parts; a third folder is not there."""
    base, p = scratch(spark, "layouts"), read(spark, sf_dir, "part")
    name = F.concat("p_name", F.when(F.col("p_partkey") % 5 == 0, F.lit("\n(more)")).otherwise(F.lit("")))
    size, label = F.col("p_size").cast("string"), F.concat(F.lit("P-"), F.col("p_partkey").cast("string")).alias("Item")
    fixed = p.filter("p_size % 2 = 0").select(label, name.alias("Data Item"), size.alias("Length"), F.lit("X").alias("Remarks"))
    piped = p.filter("p_size % 2 = 1").select(label, name.alias("Data Element"), F.lit("Text").alias("Type"), size.alias("Max Length"), F.col("p_brand").alias("Format"))
    for series, rows in (("fixed", fixed), ("piped", piped)):
        rows.write.mode("append").option("maxRecordsPerFile", FILE_ROWS).option("header", True).option("escape", '"').csv(base if together else f"{base}/{series}")
    return {"all": base} if together else {"fixed": f"{base}/fixed", "piped": f"{base}/piped", "none": f"{base}/none"}


FILES_SQL = """(SELECT CASE WHEN p_size % 2 = 0 THEN 'fixed' ELSE 'piped' END AS series, 'P-' || p_partkey AS item, p_name || CASE WHEN p_partkey % 5 = 0 THEN chr(10) || '(more)' ELSE '' END AS field_name, p_size AS length,
    CASE WHEN p_size % 2 = 0 THEN 'X' ELSE p_brand END AS notation, CASE WHEN p_size % 2 = 1 THEN 'Text' END AS type FROM part)"""


@query(f"SELECT item, field_name, length, notation, type FROM {FILES_SQL}")
def layout_files(spark, sf_dir):
    rows = layouts.canonical(layouts.read_layout_csv(spark, layout_folders(spark, sf_dir, True)["all"]))
    return rows.select(F.col("Item").alias("item"), "field_name", "length", "notation", F.col("Type").alias("type"))


@query(f"SELECT series, item, field_name, length, notation FROM {FILES_SQL}")
def combine_layouts(spark, sf_dir):
    return layouts.combine_layouts(spark, layout_folders(spark, sf_dir)).select("series", F.col("Item").alias("item"), "field_name", "length", "notation")


@query(
    f"""SELECT 'types' AS step, pos, code AS record_type, NULL::INT AS group_id FROM {LAY_SQL} UNION ALL SELECT 'groups', pos, NULL, group_id FROM (SELECT *, max(m) OVER (PARTITION BY file, group_id) AS g, max(m) OVER (PARTITION BY file) AS f
        FROM (SELECT *, {MENTION_SQL} AS m FROM {GROUPED_SQL} WHERE field_name IS DISTINCT FROM 'Length of Record' AND field_name IS NOT NULL)) WHERE g = 1 OR f = 0"""
)
def clean_flags(spark, sf_dir):
    rows = layout_rows(spark, sf_dir).withColumn("item", F.concat(F.lit("P"), F.col("item_no").cast("string"))).drop("item_no")
    types = layout.clean_layout(rows, ["field_name"], grouping=False).select(F.lit("types").alias("step"), "pos", "record_type", F.lit(None).cast("int").alias("group_id"))
    groups = layout.clean_layout(rows, ["field_name"], record_types=False).select(F.lit("groups").alias("step"), "pos", F.lit(None).cast("string").alias("record_type"), "group_id")
    return types.unionAll(groups)


@query(f"SELECT pos, coalesce(a, b) AS code FROM (SELECT o_orderkey AS pos, {CODE_SQL} AS a, CASE WHEN o_orderstatus = 'F' THEN 'F' END AS b FROM orders)")
def stated_type(spark, sf_dir):
    rows = layout_rows(spark, sf_dir).withColumn("element", F.when(F.col("status") == "F", F.lit("Record Type = F")).otherwise(F.lit("Record Type")))
    return rows.select("pos", layout.stated_type("field_name", "element").alias("code"))


@query(f"SELECT name, n FROM (SELECT trim(n) AS name, count(*) AS n FROM (SELECT {RAWNAME_SQL} AS n FROM part) GROUP BY 1) ORDER BY n DESC, name LIMIT 50")
def names_by_count(spark, sf_dir):
    return report.by_count(frequency.name_counts(raw_names(spark, sf_dir), ["n"])).limit(50)  # a top-k report


@query(f"SELECT series, coverage_pct, has_gaps FROM ({SQL['month_coverage']}) ORDER BY has_gaps, coverage_pct DESC, series LIMIT 100")
def coverage_order(spark, sf_dir):
    out = coverage.coverage(ranges(spark, sf_dir), F.lit("2001-08-01").cast("date"))
    return report.by_coverage(out).limit(100).select("series", "coverage_pct", "has_gaps")  # a top-k report


@query(f"SELECT p_partkey AS series, score, predicted FROM ({SQL['format_score']}) ORDER BY predicted, score DESC, series LIMIT 100")
def format_order(spark, sf_dir):
    score, predicted, _ = profile.format_score(*[F.col(f) for f in FLAGS[:8]])
    rows = flags(spark, sf_dir).select(F.col("p_partkey").alias("series"), score.alias("score"), predicted.alias("predicted"))
    return report.by_format(rows).limit(100)  # a top-k report


@query("SELECT o_orderstatus AS status, count(*)::VARCHAR AS n, string_agg(DISTINCT o_orderpriority, '; ' ORDER BY o_orderpriority) AS priorities FROM orders GROUP BY 1")
def report_csv(spark, sf_dir):
    path = scratch(spark, "report")
    rows = read(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.array_sort(F.collect_set("o_orderpriority")).alias("priorities"))
    report.write_report(rows, path)
    return spark.read.option("header", True).csv(path)


@query("SELECT o_orderkey, strftime(CASE WHEN o_orderkey % 3 = 0 THEN date_trunc('month', o_orderdate) WHEN o_orderkey % 3 = 1 THEN o_orderdate END, '%Y-%m-%d') AS day FROM orders")
def file_periods(spark, sf_dir):
    o = read(spark, sf_dir, "orders")
    k = F.col("o_orderkey") % 3
    month, whole = (F.concat(F.lit("a_b_"), F.date_format("o_orderdate", f), F.lit(".txt")) for f in ("yyyyMM", "yyyyMMdd"))
    found = F.when(k == 0, dates.file_period(month, F.lit("a_b"), "%Y%m")).when(k == 1, dates.file_period(whole, F.lit("a_b"), "%Y%m%d")).otherwise(dates.file_period(F.lit("a_b_x.txt"), F.lit("a_b"), "%Y%m"))
    return o.select("o_orderkey", day(found).alias("day"))


@query("SELECT n_name AS series, strftime(make_date(2000 + n_nationkey, 1 + n_nationkey % 12, 1), '%Y-%m-%d') AS min_date, CASE WHEN n_nationkey % 2 = 0 THEN 'quarterly' ELSE 'monthly' END AS frequency, r_name AS description FROM nation JOIN region ON n_regionkey = r_regionkey")
def series_entries(spark, sf_dir):
    rows = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).collect()  # a catalog, which is read on the driver
    entries = {r["n_name"]: {"min_date": f"{2000 + r['n_nationkey']}{1 + r['n_nationkey'] % 12:02d}", "extension": "zip", "date_format": "%Y%m", "description": r["r_name"], **({"frequency": "quarterly"} if r["n_nationkey"] % 2 == 0 else {})} for r in rows}
    return layouts.read_catalog(spark, entries).select("series", day("min_date").alias("min_date"), "frequency", "description")


@query(
    """SELECT s AS series, coalesce(string_agg(h, '; ' ORDER BY h), 'None') AS hints FROM (SELECT s, max(CASE WHEN r <= 10 AND o % 29 = 0 THEN '''Format'' mentions delimiter' END) AS a, max(CASE WHEN r <= 10 AND o % 31 = 0 THEN '''Remarks'' mentions pipe delimiter' END) AS b
       FROM (SELECT (o_custkey % 40)::INT AS s, row_number() OVER (PARTITION BY o_custkey % 40 ORDER BY o_orderkey) AS r, o_orderkey AS o FROM orders) GROUP BY 1) UNPIVOT INCLUDE NULLS (h FOR k IN (a, b)) GROUP BY 1"""
)
def layout_hints(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = read(spark, sf_dir, "orders").select(
        (F.col("o_custkey") % 40).cast("int").alias("series"), k.alias("pos"), F.when(k % 29 == 0, F.lit("Delimited")).otherwise(F.lit("x")).alias("Format"), F.when(k % 31 == 0, F.lit("a | b")).otherwise(F.lit("x")).alias("Remarks")
    )
    return profile.layout_hints(rows)


CHANGE = "1998-01-01"


def order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a layout for orders: from the change on, date and status have changed places and there is a total record."""
    old = [("P", i + 1, f.name, f.length, f.notation) for i, f in enumerate(ORDER)]
    new = [("P", i + 1, ORDER[k].name, ORDER[k].length, ORDER[k].notation) for i, k in enumerate((0, 1, 3, 2, 4))] + [("Z", 1, "Record Type", 1, "X"), ("Z", 2, "Order Key", 10, "9(10)")]
    rows = [("V1", None, "1997-12-31", *r) for r in old] + [("V2", CHANGE, "2099-12-31", *r) for r in new]
    lay = spark.createDataFrame(rows, "version string, a string, b string, record_type string, ordinal int, field_name string, length int, notation string")
    at = lay.withColumns({"version_from": F.col("a").cast("date"), "version_to": F.col("b").cast("date"), "Begin": F.col("ordinal"), "End": F.col("ordinal")})
    return at.drop("a", "b")


def stage_versions(spark: SparkSession, sf_dir: str) -> str:
    """Order lines by month, in the layout of their time, as staged files ord_<month>.txt; a third of the later ones have a total record too."""
    staged = scratch(spark, "staged")
    key, status, amount = number("o_orderkey", 0, 10), F.rpad("o_orderstatus", 3, " "), number("o_totalprice", 2, 15)
    when = F.date_format("o_orderdate", "yyyyMMdd")
    late = F.col("o_orderdate") >= F.lit(CHANGE).cast("date")
    line = F.when(late, F.concat(F.lit("P"), key, when, status, amount)).otherwise(F.concat(F.lit("P"), key, status, when, amount))
    total = F.when(late & (F.col("o_orderkey") % 3 == 0), F.concat(F.lit("Z"), key))
    name = F.concat(F.lit("ord_"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".txt")).alias("file")
    rows = read(spark, sf_dir, "orders").select(name, F.explode(F.array_compact(F.array(line, total))).alias("text_content"))
    lines.stage(rows.repartition("file"), staged, "ord")
    return staged


def clean_types(spark: SparkSession, clean: str) -> DataFrame:
    one = lambda code: jobs.read_clean(spark, clean, "ord", code).withColumn("record_type", F.lit(code))
    return one("P").unionByName(one("Z"), allowMissingColumns=True)


@query(
    f"""SELECT 'P' AS record_type, strftime(o_orderdate, '%Y%m') AS period, o_orderstatus AS status, count(*) AS n, sum(round(o_totalprice * 100)::BIGINT)::BIGINT AS cents, (max(strftime(o_orderdate, '%Y%m%d')::BIGINT))::BIGINT AS last FROM orders GROUP BY 2, 3
        UNION ALL SELECT 'Z', strftime(o_orderdate, '%Y%m'), NULL, count(*), NULL, NULL FROM orders WHERE o_orderkey % 3 = 0 AND o_orderdate >= DATE '{CHANGE}' GROUP BY 2"""
)
def transform_versions(spark, sf_dir):
    staged, clean = stage_versions(spark, sf_dir), scratch(spark, "clean")
    jobs.transform_versions(spark, staged, clean, "ord", order_versions(spark, sf_dir), typed_values=True)
    got = clean_types(spark, clean)
    cents = F.sum(F.round(F.col("Amount") * 100).cast("bigint")).alias("cents")
    return got.groupBy("record_type", "period", F.col("Status").alias("status")).agg(F.count(F.lit(1)).alias("n"), cents, F.max("Order Date").alias("last"))


@query(
    f"""WITH m AS (SELECT date_trunc('month', o_orderdate) AS d, count(*) AS n, count(*) FILTER (WHERE o_orderkey % 3 = 0) AS z FROM orders GROUP BY 1)
        SELECT series, record_type, status, count(*) AS files, sum(n)::BIGINT AS records FROM (SELECT 'ord' AS series, 'P' AS record_type, CASE WHEN d < DATE '1997-01-01' THEN 'skipped' ELSE 'success' END AS status,
        CASE WHEN d < DATE '1997-01-01' THEN 0 ELSE n END AS n FROM m UNION ALL SELECT 'ord', 'Z', 'success', z FROM m WHERE d >= DATE '{CHANGE}') GROUP BY 1, 2, 3"""
)
def transform_ledger(spark, sf_dir):
    staged, clean = stage_versions(spark, sf_dir), scratch(spark, "clean")
    lay = order_versions(spark, sf_dir).withColumn("series", F.lit("ord"))
    past = read(spark, sf_dir, "orders").filter(F.col("o_orderdate") < F.lit("1997-01-01").cast("date")).select(F.lit("ord").alias("series"), F.concat(F.lit("ord_"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".txt")).alias("file")).distinct()
    done = past.withColumns({"record_type": F.lit("P"), "status": F.lit("success")})
    ran = jobs.transform_all(spark, staged, clean, lay.unionByName(lay.withColumn("series", F.lit("other"))), exclude=["other"], done=done)
    return ran.groupBy("series", "record_type", "status").agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("records"))


# Reruns, changes and streams of whole series --------------------------------------------------------------------------


def version_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file, o_orderkey, line, total): stage_versions' lines, total null where there is no total record."""
    key, status, amount = number("o_orderkey", 0, 10), F.rpad("o_orderstatus", 3, " "), number("o_totalprice", 2, 15)
    when = F.date_format("o_orderdate", "yyyyMMdd")
    late = F.col("o_orderdate") >= F.lit(CHANGE).cast("date")
    line = F.when(late, F.concat(F.lit("P"), key, when, status, amount)).otherwise(F.concat(F.lit("P"), key, status, when, amount))
    total = F.when(late & (F.col("o_orderkey") % 3 == 0), F.concat(F.lit("Z"), key))
    name = F.concat(F.lit("ord_"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".txt"))
    return read(spark, sf_dir, "orders").select(name.alias("file"), "o_orderkey", line.alias("line"), total.alias("total"))


def both_lines(rows: DataFrame) -> DataFrame:
    return rows.select("file", F.explode(F.array_compact(F.array("line", "total"))).alias("text_content")).repartition("file")


@query(
    """SELECT 'P' AS record_type, strftime(o_orderdate, '%Y%m') AS period, count(*) AS n, (max(o_orderkey))::BIGINT AS last FROM orders WHERE o_orderkey % 2 = 0 OR o_orderdate < DATE '1996-01-01' GROUP BY 2"""
)
def restage_replaces(spark, sf_dir):
    """Staged and transformed twice: from 1996 on, the second time half of the lines are gone and all total records."""
    staged, clean = scratch(spark, "staged"), scratch(spark, "clean")
    rows, lay = version_lines(spark, sf_dir), order_versions(spark, sf_dir)
    lines.stage(both_lines(rows), staged, "ord")
    jobs.transform_versions(spark, staged, clean, "ord", lay, typed_values=True)
    late = rows.filter(F.col("file") >= "ord_199601")
    files = late.select("file").distinct().withColumn("source", F.lit("again"))
    lines.stage(both_lines(late.filter("o_orderkey % 2 = 0").withColumn("total", F.lit(None).cast("string"))), staged, "ord", attempted=files)
    jobs.transform_versions(spark, staged, clean, "ord", lay, typed_values=True, changed_only=True)
    return clean_types(spark, clean).groupBy("record_type", "period").agg(F.count(F.lit(1)).alias("n"), F.max("Order Key").alias("last"))


@query(
    f"""WITH m AS (SELECT date_trunc('month', o_orderdate) AS d, count(*) AS n, count(*) FILTER (WHERE o_orderkey % 3 = 0) AS z FROM orders GROUP BY 1)
        SELECT record_type, status, count(*) AS files, sum(n)::BIGINT AS records FROM (SELECT 'P' AS record_type, CASE WHEN d < DATE '{CHANGE}' THEN 'skipped' ELSE 'success' END AS status, CASE WHEN d < DATE '{CHANGE}' THEN 0 ELSE n END AS n FROM m
        UNION ALL SELECT 'Z', 'skipped', 0 FROM m WHERE d >= DATE '{CHANGE}') GROUP BY 1, 2"""
)
def changed_layout(spark, sf_dir):
    """A layout whose second version gets a wider amount: only what that version says of that record type runs again."""
    staged, clean = stage_versions(spark, sf_dir), scratch(spark, "clean")
    lay = order_versions(spark, sf_dir)
    jobs.transform_versions(spark, staged, clean, "ord", lay, typed_values=True)
    changed = lay.withColumn("notation", F.when((F.col("version") == "V2") & (F.col("field_name") == "Amount"), F.lit("9(12)v9(3)")).otherwise(F.col("notation")))
    ran = jobs.transform_versions(spark, staged, clean, "ord", changed, typed_values=True, changed_only=True)
    return ran.groupBy("record_type", "status").agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("records"))


@query(
    f"""SELECT 'decimal(16,3)' AS kind, o_orderstatus AS status, count(*) AS n, (sum(CASE WHEN o_orderdate >= DATE '{CHANGE}' THEN round(o_totalprice * 100)::BIGINT ELSE round(o_totalprice * 100)::BIGINT * 10 END))::BIGINT AS thousandths FROM orders GROUP BY 2"""
)
def common_types(spark, sf_dir):
    """An amount of two decimals in one version and of three in the other is one column of both."""
    staged, clean = stage_versions(spark, sf_dir), scratch(spark, "clean")
    lay = order_versions(spark, sf_dir)
    lay = lay.withColumn("notation", F.when((F.col("version") == "V2") & (F.col("field_name") == "Amount"), F.lit("9(12)v9(3)")).otherwise(F.col("notation")))
    jobs.transform_versions(spark, staged, clean, "ord", lay, typed_values=True, exact=True, record_types=["P"])
    got = jobs.read_clean(spark, clean, "ord", "P")
    kind = F.lit(dict(got.dtypes)["Amount"]).alias("kind")
    return got.groupBy(kind, F.col("Status").alias("status")).agg(F.count(F.lit(1)).alias("n"), (F.sum("Amount") * 1000).cast("bigint").alias("thousandths"))


def named_drops(spark: SparkSession, rows: DataFrame, name: str) -> str:
    """Rows (file, value) as text files of these names in a shared folder."""
    path, jvm = scratch(spark, name), spark._jvm
    rows.repartition("file").sortWithinPartitions("file").write.partitionBy("file").text(path)
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(p, "file=*/part-*")):  # a file for each name
        fs.rename(s.getPath(), jvm.org.apache.hadoop.fs.Path(p, s.getPath().getParent().getName().removeprefix("file=")))
        fs.delete(s.getPath().getParent(), True)
    return path


def monthly_drops(spark: SparkSession, sf_dir: str) -> str:
    """Files of the series ord, every second month's in capitals, and of a series whose name begins like it."""
    rows = version_lines(spark, sf_dir)
    name = F.when(F.substring("file", 9, 2).cast("int") % 2 == 0, F.replace(F.col("file"), F.lit(".txt"), F.lit(".TXT"))).otherwise(F.col("file"))
    own = rows.select(name.alias("file"), F.explode(F.array_compact(F.array("line", "total"))).alias("value"))
    other = rows.filter("o_orderkey % 10 = 0").select(F.replace(F.col("file"), F.lit("ord_"), F.lit("ordx_")).alias("file"), F.lit("other").alias("value"))
    return named_drops(spark, own.unionAll(other), "drops")


DROPS_SQL = f"""(SELECT 'ord_' || strftime(o_orderdate, '%Y%m') || CASE WHEN month(o_orderdate) % 2 = 0 THEN '.TXT' ELSE '.txt' END AS file, count(*) + count(*) FILTER (WHERE o_orderkey % 3 = 0 AND o_orderdate >= DATE '{CHANGE}') AS n,
    min(o_orderdate) AS d FROM orders GROUP BY 1)"""


@query(f"SELECT file, CASE WHEN d < DATE '1995-01-01' THEN 'skipped' ELSE 'success' END AS status, CASE WHEN d < DATE '1995-01-01' THEN 0 ELSE n END AS n FROM {DROPS_SQL}")
def stage_ledger(spark, sf_dir):
    """The drops of a series as its name says, in small and large letters, less those that are done."""
    source, staged = monthly_drops(spark, sf_dir), scratch(spark, "staged")
    done = read(spark, sf_dir, "orders").filter("o_orderdate < '1995-01-01'").select(F.concat(F.lit("ord_"), F.date_format("o_orderdate", "yyyyMM"), F.when(F.month("o_orderdate") % 2 == 0, F.lit(".TXT")).otherwise(F.lit(".txt"))).alias("file")).distinct()
    ran = jobs.stage_all(spark, source, staged, ["ord"], done=done.withColumns({"series": F.lit("ord"), "status": F.lit("success")}))
    return ran.select("file", "status", "n")


@query(f"SELECT 'stage' AS step, 'success' AS status, (SELECT sum(n) FROM {DROPS_SQL})::BIGINT AS records UNION ALL SELECT 'transform', 'success', (SELECT sum(n) FROM {DROPS_SQL})::BIGINT UNION ALL SELECT 'rows', 'P', count(*) FROM orders")
def run_pipeline(spark, sf_dir):
    """Drops to rows: the status of each step, what its ledger counts, and the rows that are there."""
    source, staged, clean = monthly_drops(spark, sf_dir), scratch(spark, "staged"), scratch(spark, "clean")
    steps, ledgers = jobs.run_series(spark, source, staged, clean, "ord", order_versions(spark, sf_dir))
    out = [ledgers[step].agg(F.lit(step).alias("step"), F.lit(status).alias("status"), F.sum("n").alias("records")) for step, status in steps]
    rows = jobs.read_clean(spark, clean, "ord", "P").agg(F.lit("rows").alias("step"), F.lit("P").alias("status"), F.count(F.lit(1)).alias("records"))
    return out[0].unionAll(out[1]).unionAll(rows)


@query(
    f"""SELECT 'P' AS record_type, strftime(o_orderdate, '%Y%m') AS period, o_orderstatus AS status, count(*) AS n, (max(strftime(o_orderdate, '%Y%m%d')::BIGINT))::BIGINT AS last FROM orders GROUP BY 2, 3
        UNION ALL SELECT 'Z', strftime(o_orderdate, '%Y%m'), NULL, count(*), NULL FROM orders WHERE o_orderkey % 3 = 0 AND o_orderdate >= DATE '{CHANGE}' GROUP BY 2"""
)
def stream_versions(spark, sf_dir):
    """Drops as a stream, each by the layout of its time; a second run finds what has come since, and the rest is not read again."""
    source, clean, checkpoint = monthly_drops(spark, sf_dir), scratch(spark, "clean"), scratch(spark, "checkpoint")
    for _ in range(2):
        ingest_versions(spark, source, clean, checkpoint, "ord", order_versions(spark, sf_dir), options=jobs.Options(typed_values=True))
    return clean_types(spark, clean).groupBy("record_type", "period", F.col("Status").alias("status")).agg(F.count(F.lit(1)).alias("n"), F.max("Order Date").alias("last"))


@query(f"SELECT o_orderkey, CASE WHEN o_orderkey % 9 < 7 THEN strftime(CASE o_orderkey % 9 WHEN 5 THEN date_trunc('month', o_orderdate) ELSE o_orderdate END, '%Y-%m-%d') END AS day FROM orders")
def known_dates(spark, sf_dir):
    k = F.col("o_orderkey") % 9
    value = F.when(k == 7, F.lit(""))
    for i, (_, _, java) in enumerate(dates.FORMATS):
        value = value.when(k == i, F.date_format("o_orderdate", java))
    return read(spark, sf_dir, "orders").select("o_orderkey", day(dates.known_date(value)).alias("day"))


@query("SELECT p_partkey, replace(p_name, ' ', ' ') || ' a  b' AS name FROM part")
def names_on_one_line(spark, sf_dir):
    return read(spark, sf_dir, "part").select("p_partkey", text.one_line(F.concat("p_name", F.lit("\na\r\nb"))).alias("name"))


@query("SELECT p_partkey, p_size AS item_no FROM part WHERE p_partkey % 4 <> 0")
def labels_with_digits(spark, sf_dir):
    label = F.when(F.col("p_partkey") % 4 == 0, F.lit("Item")).otherwise(F.concat(F.lit("LR-"), F.lpad(F.col("p_size").cast("string"), 3, "0"), F.lit(" of 9")))
    return read(spark, sf_dir, "part").select("p_partkey", text.item_number(label).alias("item_no")).filter("item_no IS NOT NULL")


#: Rows of a layout file that a query writes.
FILE_ROWS = 10_000
WIDE = [f"c{k}" for k in range(77)] + ["A", "A", "A_1"]


@query("SELECT p_partkey::VARCHAR AS c0, p_name AS c76, p_brand AS a, p_type AS a_1, p_size::VARCHAR AS a_1_1, 80 AS columns FROM part")
def wide_layout(spark, sf_dir):
    """Eighty columns, of which the last three are called A, A and A_1."""
    path, p = scratch(spark, "wide"), read(spark, sf_dir, "part")
    value = {0: F.col("p_partkey").cast("string"), 76: F.col("p_name"), 77: F.col("p_brand"), 78: F.col("p_type"), 79: F.col("p_size").cast("string")}
    cells = [value.get(k, F.lit(str(k))) for k in range(len(WIDE))]
    rows = p.select(F.monotonically_increasing_id().alias("id"), F.concat_ws(",", *cells).alias("value"))
    at = F.col("id").bitwiseAND(F.lit((1 << 33) - 1))  # the row's place in its partition
    head = F.when(at % FILE_ROWS == 0, F.lit(",".join(WIDE)))
    body = rows.select(F.concat_ws("-", F.shiftright("id", 33), F.floor(at / FILE_ROWS)).alias("file"), "id", F.posexplode(F.array_compact(F.array(head, "value"))).alias("k", "value"))
    body.repartition("file").sortWithinPartitions("file", "id", "k").select("file", "value").write.partitionBy("file").text(path)
    got = layouts.read_layout_csv(spark, path)
    n = len([c for c in got.columns if c not in ("layout_file", "pos", "version_from", "version_to")])
    return got.select("c0", "c76", F.col("A").alias("a"), F.col("A_1").alias("a_1"), F.col("A_1_1").alias("a_1_1"), F.lit(n).alias("columns"))


# Links and coverage, further forms -------------------------------------------------------------------------------------

NAMES_SQL = "(SELECT DISTINCT 'p' || (p_partkey % 60) || '_' || p_size || CASE p_partkey % 3 WHEN 0 THEN '.zip' ELSE '' END AS file_name FROM part)"
HREFS_SQL = "(SELECT '/get?f=p' || (c_custkey % 70) || '_' || (c_custkey % 53) || CASE c_custkey % 2 WHEN 0 THEN '.zip' ELSE '0' END || '&v=' || c_custkey AS href FROM customer)"


@query(f"SELECT file_name FROM {NAMES_SQL} n WHERE NOT EXISTS (SELECT 1 FROM {HREFS_SQL} h WHERE contains(h.href, n.file_name))")
def missing_within_links(spark, sf_dir):
    """Names of four to ten characters, of which some are parts of others."""
    k = F.col("p_partkey")
    name = F.concat(F.lit("p"), (k % 60).cast("string"), F.lit("_"), F.col("p_size").cast("string"), F.when(k % 3 == 0, F.lit(".zip")).otherwise(F.lit("")))
    c = F.col("c_custkey")
    href = F.concat(F.lit("/get?f=p"), (c % 70).cast("string"), F.lit("_"), (c % 53).cast("string"), F.when(c % 2 == 0, F.lit(".zip")).otherwise(F.lit("0")), F.lit("&v="), c.cast("string"))
    expected = read(spark, sf_dir, "part").select(name.alias("file_name")).distinct()
    return coverage.missing_files(expected, read(spark, sf_dir, "customer").select(href.alias("href")), within=True)


@query(f"SELECT page_id, link_no, replace(href, '&amp;', '&') AS href FROM {LINKS_SQL}")
def parsed_links(spark, sf_dir):
    return links.parsed_links(read(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "link_no", "href")


@query(SQL["month_coverage"])
def merged_coverage(spark, sf_dir):
    """Coverage from sets of four parts of the ranges, kept as a table and changed by each."""
    r = ranges(spark, sf_dir).withColumn("end", dates.clamp_end("end", F.lit("2001-08-01").cast("date")))
    sets = None
    for k in range(4):
        part = coverage.interval_sets(r.filter(F.pmod(F.xxhash64("series", "start"), F.lit(4)) == k))
        sets = part if sets is None else coverage.merge_sets(sets.unionByName(part))
        path = scratch(spark, f"coverage{k}")
        sets.write.parquet(path)
        sets = spark.read.schema(sets.schema).parquet(path)
    return coverage.coverage_of(sets).withColumns({"min_start": day("min_start"), "max_end": day("max_end")})


@query(
    f"""SELECT 'formats' AS report, series AS key, CASE series WHEN 'fixed' THEN '-2 FIXED-WIDTH' ELSE '6 DELIMITED' END AS value FROM (SELECT DISTINCT series FROM {FILES_SQL})
        UNION ALL SELECT 'names', name, n || ' ' || name FROM (SELECT replace(trim(field_name), chr(10), chr(10)) AS name, count(*) AS n FROM {FILES_SQL} GROUP BY 1) WHERE NOT contains(name, '(')
        UNION ALL SELECT 'profile', series, count(*) || ' ' || CASE series WHEN 'fixed' THEN 'UNKNOWN' ELSE 'DELIMITED' END FROM {FILES_SQL} GROUP BY series"""
)
def layout_reports(spark, sf_dir):
    """Layout files of several series to their reports, in one go."""
    out = reports.layout_reports(layouts.combine_layouts(spark, layout_folders(spark, sf_dir)), F.lit("2025-08-21").cast("date"))
    row = lambda report, df, key, *values: df.select(F.lit(report).alias("report"), F.col(key).alias("key"), F.concat_ws(" ", *values).alias("value"))
    plain = out["names"].filter(~F.col("name").contains("("))
    return row("formats", out["formats"], "series", "score", "predicted").unionAll(row("names", plain, "name", "n", "name")).unionAll(row("profile", out["profile"], "series", "n_rows", "format"))


@query(
    f"""WITH m AS (SELECT *, min(CASE WHEN misses >= 6 THEN step END) OVER (PARTITION BY series) AS stop FROM {MISS_SQL})
        SELECT series, (max(step) + 1)::INT AS steps, (count(*) FILTER (WHERE hit))::INT AS hits, max(stop) AS stop, (arg_max(misses, step) FILTER (WHERE stop IS NULL OR step <= stop))::INT AS misses FROM m GROUP BY 1"""
)
def stream_misses(spark, sf_dir):
    """Miss runs of all series as a stream with state: files arrive in three parts, out of order."""
    expected, have = expected_with_links(spark, sf_dir)
    linked = have.select(F.element_at(F.split("href", "/"), -1).alias("file_name"), F.lit(True).alias("linked")).distinct()
    rows = expected.join(linked, "file_name", "left").select("series", "step", F.col("linked").isNotNull().alias("hit"), F.pmod(F.xxhash64("file_name"), F.lit(3)).alias("part"))
    source, target, checkpoint = (scratch(spark, n) for n in ("arrivals", "misses", "checkpoint"))
    for k in (2, 0, 1):
        rows.filter(F.col("part") == k).drop("part").write.mode("append").parquet(source)
        arrived = spark.readStream.schema("series string, step int, hit boolean").parquet(source)
        misses.run_miss_status(arrived, 6, target, checkpoint)
    return misses.newest_status(spark.read.schema(f"{misses.STATUS}, batch int").parquet(target))
