"""Registered queries of the engine and the SQL that gives the same rows.

The tables are rendered to fixed-width lines in Spark, decoded again, and compared with SQL on the originals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fwloom.layouts import Computed, Field, Layout
from fwloom.operators import catalog, discovery, numbering, planning, quality
from fwloom.operators import decode as D
from fwloom.storage import kept_dir

LINEITEM = Layout("imports", "1990-01", "1990-01", 80, (
    Field("l_orderkey", 1, 12, "Int64"), Field("l_partkey", 13, 12, "Int64"), Field("l_suppkey", 25, 12, "Int64"),
    Field("l_linenumber", 37, 3, "Int64"), Field("l_quantity", 40, 12, "Float64"), Field("l_extendedprice", 52, 15, "Float64"),
    Field("l_returnflag", 67, 1, "Utf8"), Field("l_linestatus", 68, 1, "Utf8"), Field("l_shipdate", 69, 8, "Date"),
), "l_shipdate")
COLUMNS = [f.physical_name for f in LINEITEM.columns]
#: SQL of the decoded columns.
PLAIN = "cast(l_orderkey as bigint) l_orderkey, cast(l_partkey as bigint) l_partkey, cast(l_suppkey as bigint) l_suppkey, cast(l_linenumber as bigint) l_linenumber, l_quantity, l_extendedprice, l_returnflag, l_linestatus, cast(l_shipdate as date) l_shipdate"
#: A total order of the rows of a file, which is a year of shipments.
ORDER = "l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus"
FILE = "cast(year(l_shipdate) as varchar)"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def changed(layout: Layout, **changes: dict) -> Layout:
    """``layout`` with attributes of some fields changed."""
    from dataclasses import replace

    return replace(layout, columns=tuple(replace(f, **changes.get(f.physical_name, {})) for f in layout.columns))


def lineitem_lines(spark: SparkSession, sf_dir: str, numbered: bool = True) -> DataFrame:
    """input_path (the year), line_no, raw_line and the columns they were made from."""
    df = read(spark, sf_dir, "lineitem").select(*COLUMNS)
    df = df.withColumn("input_path", F.year("l_shipdate").cast("string"))
    df = numbering.numbered(df, ["input_path"], ORDER.split(", ")) if numbered else df.withColumn("line_no", F.lit(0).cast("long"))
    return df.withColumn("raw_line", D.render(df, LINEITEM))


def numbered_sql(extra: str = "") -> str:
    return f"WITH t AS (SELECT {PLAIN}, {FILE} AS input_path, row_number() OVER (PARTITION BY {FILE} ORDER BY {ORDER}) AS line_no FROM lineitem){extra}"


QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


@query(f"SELECT {PLAIN} FROM lineitem")
def fwf_decode_lineitem(spark, sf_dir):
    return D.good_rows(D.decode(lineitem_lines(spark, sf_dir, False), LINEITEM), LINEITEM)


@query(f"SELECT {PLAIN} FROM lineitem")
def fwf_table_function(spark, sf_dir):
    """The same rows by the table function of SQL, whose columns are the layout's."""
    from fwloom.functions import table

    table.register(spark, {"lineitem": LINEITEM})
    lineitem_lines(spark, sf_dir, False).select("raw_line").createOrReplaceTempView("fwf_table_function_lines")
    return spark.sql("SELECT * FROM fwf_decode(TABLE(fwf_table_function_lines), 'lineitem')")


@query("SELECT l_returnflag, l_linestatus, cast(count(*) as bigint) AS n, cast(sum(l_orderkey) as bigint) AS keys FROM lineitem WHERE l_shipdate < DATE '1997-01-01' GROUP BY 1, 2")
def fwf_project_aggregate(spark, sf_dir):
    rows = D.project(lineitem_lines(spark, sf_dir, False), LINEITEM, ["l_returnflag", "l_linestatus", "l_orderkey", "l_shipdate"], F.col("l_shipdate") < "1997-01-01")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"))


ORDERS = Layout("imports", "1990-01", "1990-01", 60, (Field("o_month", 1, 6, "Date", parse="yyyymm_to_date"), Field("o_day", 7, 2, "Int64"), Field("o_orderkey", 9, 12, "Int64"), Field("o_orderpriority", 21, 20, "Utf8"), Field("o_totalprice", 41, 15, "Float64")), "o_month")


def orders_lines(spark: SparkSession, sf_dir: str, day=None) -> DataFrame:
    df = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", F.to_date("o_orderdate").alias("o_month"), F.dayofmonth("o_orderdate").alias("o_day"))
    df = df.withColumn("o_day", day) if day is not None else df
    return df.select(F.lit("orders").alias("input_path"), F.lit(0).cast("long").alias("line_no"), D.render(df, ORDERS).alias("raw_line"))


@query("SELECT cast(date_trunc('month', o_orderdate) as date) AS o_month, cast(day(o_orderdate) as bigint) AS o_day, o_orderkey, o_orderpriority, o_totalprice FROM orders")
def fwf_decode_orders_yyyymm(spark, sf_dir):
    return D.good_rows(D.decode(orders_lines(spark, sf_dir), ORDERS), ORDERS).select("o_month", "o_day", "o_orderkey", "o_orderpriority", "o_totalprice")


def splice(start: int, text: str):
    """The line with ``text`` put over it from ``start`` on."""
    return F.overlay("raw_line", F.lit(text), start)


@query("SELECT l_orderkey, cast(l_linenumber as bigint) AS l_linenumber, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity END AS l_quantity, CASE WHEN l_linenumber = 2 THEN NULL ELSE l_returnflag END AS l_returnflag FROM lineitem")
def fwf_blank_to_null(spark, sf_dir):
    lines = lineitem_lines(spark, sf_dir, False)
    line = F.when(F.col("l_linenumber") == 3, splice(40, " " * 12)).when(F.col("l_linenumber") == 2, splice(67, " ")).otherwise(F.col("raw_line"))
    return D.good_rows(D.decode(lines.withColumn("raw_line", line), LINEITEM), LINEITEM).select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag")


def broken_quantities(lines: DataFrame) -> DataFrame:
    return lines.withColumn("raw_line", F.when(F.col("l_orderkey") % 7 == 0, splice(40, "       ABCDE")).otherwise(F.col("raw_line")))


def broken(spark: SparkSession, sf_dir: str, numbered: bool = True) -> DataFrame:
    """Every seventh order has letters for a quantity, every eleventh also a blank part key."""
    lines = broken_quantities(lineitem_lines(spark, sf_dir, numbered))
    return lines.withColumn("raw_line", F.when(F.col("l_orderkey") % 11 == 0, splice(13, " " * 12)).otherwise(F.col("raw_line")))


STRICT = changed(LINEITEM, l_partkey={"nullable": False})


@query(f"SELECT {PLAIN} FROM lineitem WHERE l_orderkey % 7 <> 0 AND l_orderkey % 11 <> 0")
def fwf_row_reject(spark, sf_dir):
    return D.good_rows(D.decode(broken(spark, sf_dir, False), STRICT), STRICT)


@query("""SELECT CASE WHEN l_orderkey % 11 = 0 THEN 'l_partkey' ELSE 'l_quantity' END AS "column", CASE WHEN l_orderkey % 11 = 0 THEN 'blank value in non-nullable column' ELSE 'cannot parse ''ABCDE'' as Float64' END AS message, cast(count(*) as bigint) AS n FROM lineitem WHERE l_orderkey % 7 = 0 OR l_orderkey % 11 = 0 GROUP BY 1, 2""")
def fwf_quality_issues(spark, sf_dir):
    found = quality.issues(D.decode(broken(spark, sf_dir, False), STRICT), "l_shipdate", F.col("input_path").cast("int"), F.lit(12))
    return found.groupBy("column", "message").agg(F.count("*").alias("n"))


COERCE = changed(LINEITEM, l_shipdate={"coerce_invalid_to_null": True})


def sentinels(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = broken(spark, sf_dir, False)
    return lines.withColumn("raw_line", F.when(F.col("l_orderkey") % 5 == 0, splice(69, "00000000")).otherwise(F.col("raw_line")))


@query("SELECT l_orderkey, CASE WHEN l_orderkey % 5 = 0 THEN NULL ELSE cast(l_shipdate as date) END AS l_shipdate FROM lineitem WHERE l_orderkey % 7 <> 0")
def fwf_coerce_null(spark, sf_dir):
    return D.good_rows(D.decode(sentinels(spark, sf_dir), COERCE), COERCE).select("l_orderkey", "l_shipdate")


@query(f"SELECT {FILE} AS input_path, 'l_shipdate' AS \"column\", cast(count(*) as bigint) AS n FROM lineitem WHERE l_orderkey % 5 = 0 AND l_orderkey % 7 <> 0 GROUP BY 1")
def fwf_coerced_counts(spark, sf_dir):
    return quality.coerced_counts(D.decode(sentinels(spark, sf_dir), COERCE))


def issues_of(spark: SparkSession, sf_dir: str, lines: DataFrame, layout: Layout = LINEITEM) -> DataFrame:
    return quality.issues(D.decode(lines, layout), "l_shipdate", F.col("input_path").cast("int"), F.lit(12))


@query(numbered_sql(" SELECT input_path, cast(min(line_no) as bigint) AS abort_line FROM t WHERE input_path = '1995' AND l_orderkey % 3 = 0 GROUP BY 1"))
def fwf_record_length_verdict(spark, sf_dir):
    lines = lineitem_lines(spark, sf_dir)
    short = (F.col("input_path") == "1995") & (F.col("l_orderkey") % 3 == 0)
    lines = lines.withColumn("raw_line", F.when(short, F.substring("raw_line", 1, 70)).otherwise(F.col("raw_line")))
    return quality.verdicts(issues_of(spark, sf_dir, lines)).select("input_path", "abort_line")


BAD_SQL = numbered_sql(", b AS (SELECT *, row_number() OVER (PARTITION BY input_path ORDER BY line_no) AS n FROM t WHERE l_orderkey % 7 = 0)")


@query(BAD_SQL + " SELECT input_path, cast(min(line_no) as bigint) AS abort_line FROM b WHERE n / line_no > 0.2 GROUP BY 1")
def fwf_skip_ratio_verdict(spark, sf_dir):
    found = issues_of(spark, sf_dir, broken(spark, sf_dir))
    return quality.verdicts(found, max_skip_rate=0.2).select("input_path", "abort_line")


BATCH_SQL = numbered_sql(""", r AS (SELECT *, l_orderkey % 7 = 0 AS bad, month(l_shipdate) > 6 AS outside FROM t),
c AS (SELECT *, sum(bad::int) OVER w AS bads, sum((bad OR outside)::int) OVER w AS problems, sum((NOT bad)::int) OVER w AS good, max(line_no) OVER (PARTITION BY input_path) AS lines, sum((NOT bad)::int) OVER (PARTITION BY input_path) AS all_good FROM r WINDOW w AS (PARTITION BY input_path ORDER BY line_no ROWS UNBOUNDED PRECEDING))
SELECT input_path, cast(min(line_no) as bigint) AS abort_line FROM c WHERE bad AND bads / line_no > 0.3 OR problems / line_no > 0.3 AND (NOT bad AND good % 100 = 0 OR line_no = lines AND all_good % 100 <> 0) GROUP BY 1""")


@query(BATCH_SQL)
def fwf_skip_batch_verdict(spark, sf_dir):
    """Rows of the second half of a year belong to no month of the snapshot: only the rule by batches sees them."""
    lines = broken_quantities(lineitem_lines(spark, sf_dir))
    found = quality.issues(D.decode(lines, LINEITEM), "l_shipdate", F.col("input_path").cast("int"), F.lit(6))
    totals = lines.groupBy("input_path").agg(F.count("*").alias("lines"), F.lit(True).alias("whole"))
    return quality.verdicts(found, max_skip_rate=0.3, batch_rows=100, totals=totals).select("input_path", "abort_line")


@query(BAD_SQL + " SELECT input_path, cast(line_no as bigint) AS line_no, l_orderkey FROM b WHERE n <= 10")
def fwf_quality_cap(spark, sf_dir):
    lines = broken(spark, sf_dir)
    found = issues_of(spark, sf_dir, lines)
    kept = quality.logged(found, quality.verdicts(found, max_issues=10), 10)
    return kept.join(lines.select("input_path", "line_no", "l_orderkey"), ["input_path", "line_no"]).select("input_path", "line_no", "l_orderkey")


DATED = Layout("imports", "1990-01", "1990-01", 60, ORDERS.columns, "o_month", computed_columns=(Computed("o_date", "Date", "concat_to_date", ("o_month", "o_day")),))


@query("SELECT o_orderkey, cast(o_orderdate as date) AS o_date FROM orders")
def fwf_concat_to_date(spark, sf_dir):
    return D.good_rows(D.decode(orders_lines(spark, sf_dir), DATED), DATED).select("o_orderkey", "o_date")


@query("SELECT 'o_date' AS \"column\", cast(month(o_orderdate) as integer) AS month, cast(count(*) as bigint) AS n FROM orders WHERE month(o_orderdate) IN (2, 4, 6, 9, 11) GROUP BY 2")
def fwf_concat_to_date_invalid(spark, sf_dir):
    decoded = D.decode(orders_lines(spark, sf_dir, F.lit(31)), DATED)
    month = F.substring("raw_line", 5, 2).cast("int").alias("month")
    return D.select_decoded(decoded, F.col("error").isNotNull()).groupBy(F.col("error.column").alias("column"), month).agg(F.count("*").alias("n"))


PARTS = Layout("imports", "1990-01", "1990-01", 130, (Field("key", 1, 10, "Int64"), Field("brand", 11, 20, "Utf8"), Field("kind", 31, 40, "Utf8"), Field("period", 71, 8, "Date")), "period", computed_columns=(Computed("label", "Utf8", "concat_text", ("brand", "kind")), Computed("dashed", "Utf8", "concat_text", ("brand", "kind"), separator=" - ")))


@query("SELECT p_partkey AS key, nullif(trim(regexp_replace(concat_ws(' ', CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END, p_type), '\\s+', ' ', 'g')), '') AS label, nullif(trim(regexp_replace(concat_ws(' - ', CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END, p_type), '\\s+', ' ', 'g')), '') AS dashed FROM part")
def fwf_concat_text(spark, sf_dir):
    df = read(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.when(F.col("p_partkey") % 3 != 0, F.concat(F.lit("  "), "p_brand")).alias("brand"), F.col("p_type").alias("kind"), F.lit("2020-01-01").cast("date").alias("period"))
    lines = df.select(F.lit("part").alias("input_path"), F.lit(0).cast("long").alias("line_no"), D.render(df, PARTS).alias("raw_line"))
    return D.good_rows(D.decode(lines, PARTS), PARTS).select("key", "label", "dashed")


@query("SELECT l_orderkey AS order_id, l_returnflag AS flag, cast(l_shipdate as date) AS l_shipdate FROM lineitem")
def fwf_rename_drop(spark, sf_dir):
    from dataclasses import replace

    layout = changed(LINEITEM, l_orderkey={"logical_name": "order_id"}, l_returnflag={"logical_name": "flag"})
    layout = replace(layout, dropped_columns=tuple(c for c in COLUMNS if c not in ("l_orderkey", "l_returnflag", "l_shipdate")))
    return D.good_rows(D.decode(lineitem_lines(spark, sf_dir, False), layout), layout)


def routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = D.decode(lineitem_lines(spark, sf_dir, False), LINEITEM)
    return decoded.withColumn("reject", quality.routing_reject(F.col("row.l_shipdate"), F.lit(1995), F.lit(6), "l_shipdate"))


@query("SELECT l_orderkey, cast(l_shipdate as date) AS l_shipdate FROM lineitem WHERE year(l_shipdate) = 1995 AND month(l_shipdate) <= 6")
def route_window(spark, sf_dir):
    return D.select_decoded(routed(spark, sf_dir), F.col("reject").isNull()).select("row.l_orderkey", "row.l_shipdate")


@query("SELECT 'row period ' || strftime(l_shipdate, '%Y-%m') || ' is outside the snapshot window (1995-01..1995-06)' AS reject, cast(count(*) as bigint) AS n FROM lineitem WHERE NOT (year(l_shipdate) = 1995 AND month(l_shipdate) <= 6) GROUP BY 1")
def route_rejects(spark, sf_dir):
    return D.select_decoded(routed(spark, sf_dir), F.col("reject").isNotNull()).groupBy("reject").agg(F.count("*").alias("n"))


@query('SELECT cast(year(l_shipdate) as integer) AS year, cast(month(l_shipdate) as integer) AS month, cast(count(*) as bigint) AS "rows" FROM lineitem GROUP BY 1, 2')
def partition_counts(spark, sf_dir):
    from fwloom.plans import sinks

    rows = D.good_rows(D.decode(lineitem_lines(spark, sf_dir, False), LINEITEM), LINEITEM)
    return sinks.partition_counts(rows.select(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")))


@query("SELECT cast(year(l_shipdate) as integer) AS year, cast(month(l_shipdate) as integer) AS month, cast(count(*) as bigint) AS n, cast(sum(l_orderkey) as bigint) AS keys FROM lineitem GROUP BY 1, 2")
def partition_roundtrip(spark, sf_dir):
    from fwloom.plans import sinks

    path = kept_dir(spark)
    sinks.write_partitions(D.good_rows(D.decode(lineitem_lines(spark, sf_dir, False), LINEITEM), LINEITEM), "l_shipdate", path)
    rows = sinks.read_partitions(spark, path)
    return rows.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"))


@query("SELECT cast(year(l_shipdate) as integer) AS year, cast(month(l_shipdate) as integer) AS month, cast(count(*) as bigint) AS n FROM lineitem WHERE NOT (year(l_shipdate) = 1995 AND month(l_shipdate) <= 6) OR l_orderkey % 2 = 0 GROUP BY 1, 2")
def partition_overwrite(spark, sf_dir):
    """A second write with half of the rows of six months replaces these and no others."""
    from fwloom.plans import sinks

    path = kept_dir(spark)
    rows = D.good_rows(D.decode(lineitem_lines(spark, sf_dir, False), LINEITEM), LINEITEM)
    sinks.write_partitions(rows, "l_shipdate", path)
    sinks.write_partitions(rows.where("year(l_shipdate) = 1995 AND month(l_shipdate) <= 6 AND l_orderkey % 2 = 0"), "l_shipdate", path)
    written = sinks.read_partitions(spark, path)
    return written.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).agg(F.count("*").alias("n"))


PATTERNS = [
    {"trade_type": "imports", "label": "imports", "pattern": r"^A_(?P<year>\d{4})(?P<month>\d{2})(?P<flag>[NCX])?\.zip$", "effective_from": "1990-01", "effective_to": None},
    {"trade_type": "exports_us", "label": "exports_us", "pattern": r"^B_(?P<year>\d{4})(?P<month>\d{2})(?P<flag>[NCX])?\.zip$", "effective_from": "1990-01", "effective_to": None},
]
FLAGS = "CASE (o_orderkey * 7 + month(o_orderdate)) % (1 + month(o_orderdate) % 4) WHEN 0 THEN '' WHEN 1 THEN 'N' WHEN 2 THEN 'C' ELSE 'X' END"
NAMES = f"SELECT DISTINCT CASE WHEN o_custkey % 3 = 0 THEN 'A' WHEN o_custkey % 3 = 1 THEN 'B' ELSE 'Z' END AS sheet, year(o_orderdate) AS y, month(o_orderdate) AS m, {FLAGS} AS flag FROM orders"
FOUND_SQL = f"WITH f AS ({NAMES}), g AS (SELECT CASE sheet WHEN 'A' THEN 'imports' ELSE 'exports_us' END AS trade_type, cast(y as integer) AS year, cast(m as integer) AS month, nullif(flag, '') AS flag FROM f WHERE sheet <> 'Z')"
RANKED_SQL = FOUND_SQL + ", r AS (SELECT *, row_number() OVER (PARTITION BY trade_type, year, month ORDER BY CASE WHEN flag IS NULL THEN 0 WHEN flag = 'N' THEN 1 WHEN flag = 'C' THEN 2 ELSE 3 END) AS k FROM g)"


def discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, month = read(spark, sf_dir, "orders"), F.month("o_orderdate")
    sheet = F.when(F.col("o_custkey") % 3 == 0, "A").when(F.col("o_custkey") % 3 == 1, "B").otherwise("Z")
    flag = F.element_at(F.array(*(F.lit(x) for x in ("", "N", "C", "X"))), ((F.col("o_orderkey") * 7 + month) % (1 + month % 4) + 1).cast("int"))
    files = orders.select(F.concat(F.lit("/drop/"), sheet, F.lit("_"), F.date_format("o_orderdate", "yyyyMM"), flag, F.lit(".zip")).alias("path")).distinct()
    return discovery.unambiguous(discovery.match(files, PATTERNS)).select("path", "trade_type", "year", "month", "flag")


@query(FOUND_SQL + " SELECT trade_type, year, month, flag FROM g")
def discover_match(spark, sf_dir):
    return discovered(spark, sf_dir).drop("path")


@query(RANKED_SQL + " SELECT trade_type, year, month, flag FROM r WHERE k = 1")
def discover_flag_dedup(spark, sf_dir):
    return discovery.prefer_flag(discovered(spark, sf_dir)).drop("path")


@query(RANKED_SQL + " SELECT trade_type, year, max(month) AS month FROM r WHERE k = 1 GROUP BY 1, 2")
def discover_latest_snapshot(spark, sf_dir):
    return discovery.latest_snapshot(discovery.prefer_flag(discovered(spark, sf_dir))).select("trade_type", "year", "month")


@query(FOUND_SQL + " SELECT trade_type, year, month, flag FROM g WHERE year = 1996")
def ytd_filter(spark, sf_dir):
    return discovery.year_to_date(discovered(spark, sf_dir), 1996).drop("path")


@query("SELECT DISTINCT CASE WHEN o_custkey % 3 = 0 THEN 'imports' ELSE 'exports_us' END AS trade_type, cast(year(o_orderdate) as integer) AS year, cast(month(o_orderdate) as integer) AS month FROM orders WHERE o_custkey % 3 < 2")
def discover_first_match(spark, sf_dir):
    """Of several patterns that match a name, the first in their order."""
    orders = read(spark, sf_dir, "orders")
    sheet = F.when(F.col("o_custkey") % 3 == 0, "A").when(F.col("o_custkey") % 3 == 1, "B").otherwise("Z")
    files = orders.select(F.concat(F.lit("/drop/"), sheet, F.lit("_"), F.date_format("o_orderdate", "yyyyMM"), F.lit(".zip")).alias("path")).distinct()
    wide = {"trade_type": "exports_us", "label": "wide", "pattern": r"^[AB]_(?P<year>\d{4})(?P<month>\d{2})\.zip$", "effective_from": "1990-01", "effective_to": None}
    return discovery.first_match(discovery.match(files, [PATTERNS[0], wide])).select("trade_type", "year", "month")


VERSIONS = [("t", "v1", "1990-01", "1993-12"), ("t", "v2", "1994-01", "1995-06"), ("t", "v3", "1995-06", "1996-12"), ("t", "v4", "1998-01", None)]
VERSIONS_SQL = "v(version, effective_from, effective_to) AS (VALUES ('v1', '1990-01', '1993-12'), ('v2', '1994-01', '1995-06'), ('v3', '1995-06', '1996-12'), ('v4', '1998-01', NULL))"


@query(f"WITH {VERSIONS_SQL}, p AS (SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS period FROM orders) SELECT period, max_by(version, effective_from) AS version FROM p LEFT JOIN v ON period >= effective_from AND (effective_to IS NULL OR period <= effective_to) GROUP BY period")
def spec_resolve_asof(spark, sf_dir):
    versions = spark.createDataFrame(VERSIONS, "trade_type string, version string, effective_from string, effective_to string")
    periods = read(spark, sf_dir, "orders").select(F.lit("t").alias("trade_type"), F.date_format("o_orderdate", "yyyy-MM").alias("period")).distinct()
    return discovery.resolve(periods, versions).select("period", "version")


@query("""WITH y AS (SELECT year(o_orderdate) AS y, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY 1),
v AS (SELECT strftime(a, '%Y-%m') AS effective_from, strftime(b + CASE y % 3 WHEN 0 THEN INTERVAL 40 DAY WHEN 1 THEN INTERVAL (-40) DAY ELSE INTERVAL 0 DAY END, '%Y-%m') AS effective_to FROM y),
l AS (SELECT *, lag(effective_to) OVER (ORDER BY effective_from) AS previous FROM v)
SELECT effective_from, CASE WHEN previous >= effective_from THEN 'overlap' ELSE 'gap' END AS problem FROM l WHERE previous IS NOT NULL AND (previous >= effective_from OR strftime(cast(previous || '-01' AS date) + INTERVAL 1 MONTH, '%Y-%m') <> effective_from)""")
def spec_windows_lint(spark, sf_dir):
    """A window for each year of orders, some stretched into the next year, some cut short."""
    years = read(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.min("o_orderdate").alias("a"), F.max("o_orderdate").alias("b"))
    end = F.date_add("b", F.when(F.col("y") % 3 == 0, 40).when(F.col("y") % 3 == 1, -40).otherwise(0))
    versions = years.select(F.lit("t").alias("trade_type"), F.date_format("a", "yyyy-MM").alias("effective_from"), F.date_format(end, "yyyy-MM").alias("effective_to"))
    return catalog.window_problems(versions).select("effective_from", "problem")


@query("WITH a AS (SELECT c_custkey AS k, c_nationkey AS n FROM customer WHERE c_custkey % 5 <> 0), b AS (SELECT s_suppkey AS k, s_nationkey AS n FROM supplier WHERE s_suppkey % 7 <> 0) SELECT coalesce(a.k, b.k) AS k, a.n AS old_n, b.n AS new_n, CASE WHEN a.k IS NULL THEN 'added' WHEN b.k IS NULL THEN 'removed' ELSE 'changed' END AS change FROM a FULL OUTER JOIN b ON a.k = b.k WHERE a.n IS DISTINCT FROM b.n OR a.k IS NULL OR b.k IS NULL")
def spec_diff(spark, sf_dir):
    old = read(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").alias("n"))
    new = read(spark, sf_dir, "supplier").where("s_suppkey % 7 <> 0").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("n"))
    return catalog.diff(old, new, "k", ["n"])


@query("SELECT l_orderkey, l_returnflag, NULL::double AS l_quantity, cast(l_shipdate as date) AS l_shipdate FROM lineitem WHERE year(l_shipdate) <= 1994 UNION ALL SELECT l_orderkey, NULL, l_quantity, cast(l_shipdate as date) FROM lineitem WHERE year(l_shipdate) > 1994")
def spec_union_columns(spark, sf_dir):
    """Two layout versions with different columns, read as one table."""
    rows = D.good_rows(D.decode(lineitem_lines(spark, sf_dir, False), LINEITEM), LINEITEM)
    old = rows.where("year(l_shipdate) <= 1994").select("l_orderkey", "l_returnflag", "l_shipdate")
    return old.unionByName(rows.where("year(l_shipdate) > 1994").select("l_orderkey", "l_quantity", "l_shipdate"), allowMissingColumns=True)


@query("""WITH c AS (SELECT 'column_' || (l_partkey % 40) AS name, strftime(l_shipdate, '%Y-%m') AS version, l_linenumber AS position, CASE l_partkey % 3 WHEN 0 THEN 'Utf8' WHEN 1 THEN 'Int64' ELSE 'Date' END AS dtype, l_returnflag = 'R' AS nullable, l_partkey % 40 AS k FROM lineitem WHERE l_partkey % 40 % 3 = l_partkey % 3)
SELECT name, min(dtype) AS dtype, bool_or(nullable) AS nullable FROM c GROUP BY name""")
def catalog_union(spark, sf_dir):
    """Columns named and typed by part, in versions by month: one merged schema."""
    rows = read(spark, sf_dir, "lineitem").where("l_partkey % 40 % 3 = l_partkey % 3")
    dtype = F.when(F.col("l_partkey") % 3 == 0, "Utf8").when(F.col("l_partkey") % 3 == 1, "Int64").otherwise("Date")
    columns = rows.select(F.concat(F.lit("column_"), F.col("l_partkey") % 40).alias("name"), F.date_format("l_shipdate", "yyyy-MM").alias("version"), F.col("l_linenumber").alias("position"), dtype.alias("dtype"), (F.col("l_returnflag") == "R").alias("nullable"))
    return catalog.union_columns(columns)


FILES_SQL = "f AS (SELECT DISTINCT strftime(o_orderdate, 'A_%Y%m') AS name, cast(year(o_orderdate) as integer) AS year, cast(month(o_orderdate) as integer) AS month FROM orders)"
DIRTY = "month = 5 AND year = 1993 OR month = 7 AND year = 1996"


@query(f"WITH {FILES_SQL} SELECT name, year FROM f WHERE year IN (SELECT year FROM f WHERE {DIRTY} OR year = 1998)")
def ops_dirty_years(spark, sf_dir):
    """New content in two files and a missing output in 1998 make all siblings of these years dirty."""
    files = read(spark, sf_dir, "orders").select(F.date_format("o_orderdate", "'A_'yyyyMM").alias("name"), F.lit("imports").alias("trade_type"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).distinct()
    files = files.select("*", F.lit(20).alias("mtime"), F.sha2(F.concat("name", F.when(F.expr(DIRTY), "x").otherwise("")), 256).alias("sha256"), (F.col("year") != 1998).alias("output_present"))
    manifest = files.select("name", F.sha2("name", 256).alias("raw_hash"), F.lit("c").alias("config_hash"), F.lit(10).alias("processed_at"))
    dirty = planning.dirty_files(files, manifest, "c")
    return planning.files_of_dirty_years(files, dirty).select("name", "year")


@query("""WITH p AS (SELECT year(l_shipdate) AS y, l_linenumber AS m, count(*) AS n, sum((l_orderkey % 7 = 0)::int) AS bad, sum((l_orderkey % 5 = 0 AND l_orderkey % 7 <> 0)::int) AS nulled FROM lineitem GROUP BY 1, 2),
f AS (SELECT *, sum(bad) OVER (PARTITION BY y) AS skipped, sum(nulled) OVER (PARTITION BY y) AS coerced FROM p)
SELECT cast(count(*) FILTER (m <> 7) AS bigint) AS ok_count, cast(count(*) FILTER (m = 7) AS bigint) AS failed_count, cast(sum(n - bad) AS bigint) AS total_rows, cast(sum(skipped) AS bigint) AS total_skipped, cast((SELECT sum(c) FROM (SELECT max(coerced) AS c FROM f GROUP BY y)) AS bigint) AS total_coerced FROM f""")
def run_summary(spark, sf_dir):
    """Results of a run: a row for each year and part, with the year's skipped rows and coerced values in each."""
    decoded = D.decode(sentinels(spark, sf_dir), COERCE)
    parts = decoded.groupBy("input_path", F.col("row.l_linenumber").alias("part")).agg(F.count_if(F.col("error").isNull()).alias("rows_written"))
    files = decoded.groupBy("input_path").agg(F.count_if(F.col("error").isNotNull()).alias("rows_skipped"))
    counts = quality.coerced_counts(decoded).groupBy("input_path").agg(F.map_from_entries(F.collect_list(F.struct("column", "n"))).alias("coerced_counts"))
    results = parts.join(files, "input_path").join(counts, "input_path", "left").withColumn("status", F.when(F.col("part") == 7, "failed").otherwise("ok"))
    return quality.run_totals(results)


@query("SELECT cast(count(*) as bigint) AS total_coerced FROM lineitem WHERE l_orderkey % 5 = 0 AND l_orderkey % 7 <> 0")
def run_total_coerced(spark, sf_dir):
    counts = quality.coerced_counts(D.decode(sentinels(spark, sf_dir), COERCE)).select("input_path", F.col("n").alias("coerced"))
    months = spark.range(3).select(F.col("id").alias("part"))
    return quality.total_coerced(counts.join(F.broadcast(months), F.col("part") >= 0))


@query(f"WITH {FILES_SQL}, y AS (SELECT DISTINCT year FROM f WHERE {DIRTY} OR year = 1998) SELECT year, year IN (SELECT year FROM y) AS dirty FROM (SELECT DISTINCT year FROM f) WHERE year % 2 = 0")
def ops_only_keys(spark, sf_dir):
    """Even years are asked for: those that are dirty, and those that are clean."""
    files = read(spark, sf_dir, "orders").select(F.lit("imports").alias("trade_type"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")).distinct()
    dirty, clean = planning.restrict(files.where(F.expr(f"{DIRTY} OR year = 1998")).select("trade_type", "year").distinct(), files.where("year % 2 = 0").select("trade_type", "year").distinct())
    return dirty.select("year", F.lit(True).alias("dirty")).unionByName(clean.select("year", F.lit(False).alias("dirty")))


@query("""SELECT p_partkey AS key, CASE WHEN p_partkey % 5 = 0 THEN 'new' WHEN p_partkey % 7 = 0 THEN 'configuration' WHEN p_partkey % 3 = 0 THEN 'content' ELSE 'output missing' END AS reason
FROM part WHERE p_partkey % 5 = 0 OR p_partkey % 7 = 0 OR p_partkey % 3 = 0 OR p_partkey % 11 = 0""")
def ops_dirty_workbooks(spark, sf_dir):
    """A workbook for each part: some unknown, of another configuration, of new content, or without output."""
    books = read(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("name"), F.sha2("p_name", 256).alias("sha256"), (F.col("p_partkey") % 11 != 0).alias("outputs_present"), "p_partkey", "p_name")
    known = books.where("p_partkey % 5 <> 0")
    manifest = known.select("name", F.sha2(F.concat("p_name", F.when(F.col("p_partkey") % 3 == 0, "x").otherwise("")), 256).alias("workbook_hash"), F.when(F.col("p_partkey") % 7 == 0, "old").otherwise("now").alias("config_hash"))
    return planning.dirty_workbooks(books.select("name", "sha256", "outputs_present"), manifest, "now").select(F.col("name").cast("long").alias("key"), "reason")


@query("SELECT cast(o_custkey as varchar) AS name, max_by(o_orderstatus, o_orderkey) AS raw_hash, max(o_orderkey) AS processed_at FROM orders GROUP BY 1")
def ops_manifest_latest(spark, sf_dir):
    """A manifest with an entry for each order: the last of each customer counts."""
    from fwloom.plans import cycle

    folder = kept_dir(spark)
    entries = read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("name"), F.col("o_orderstatus").alias("raw_hash"), F.lit("c").alias("config_hash"), F.col("o_orderkey").alias("processed_at"))
    entries.write.json(f"{folder}/raw")
    return cycle.manifest(spark, folder.removeprefix("file://"), "raw", cycle.RAW_MANIFEST).select("name", "raw_hash", "processed_at")


@query("SELECT cast(count(DISTINCT strftime(o_orderdate, '%Y-%m')) as bigint) AS files, cast(sum(o_orderkey) as bigint) AS bytes FROM orders")
def ops_volume(spark, sf_dir):
    """A file for each month of orders, as large as its keys add up to."""
    files = read(spark, sf_dir, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("name")).agg(F.sum("o_orderkey").alias("size"))
    return planning.volume(files)


@query(numbered_sql(" SELECT input_path, cast(line_no as bigint) AS line_no, l_orderkey FROM t WHERE line_no <= 5"))
def inspect_head(spark, sf_dir):
    lines = lineitem_lines(spark, sf_dir).where("line_no <= 5")
    return D.decode(lines, LINEITEM).select("input_path", "line_no", "row.l_orderkey")


def pack_files(rows: DataFrame, folder: str, order: list[str], end: str = "\n", notes: bool = False, kind: str = "deflated", encoding: str = "utf-8") -> None:
    """Writes ``raw_line`` as one file for each ``file`` (its name), in ``order``, as the lines stream by; a repeated task replaces its files.

    ``kind``: deflated or stored archives, or plain files. With ``notes`` an archive starts with a small member beside the data.
    """
    import contextlib
    import zipfile

    from pyspark import TaskContext

    from fwloom.storage import open_fs

    @contextlib.contextmanager
    def writer(sink):
        if kind == "plain":
            yield sink
            return
        with zipfile.ZipFile(sink, "w", zipfile.ZIP_STORED if kind == "stored" else zipfile.ZIP_DEFLATED) as z:
            if notes:
                z.writestr("readme.txt", "aux")
            with z.open("data.fwf", "w", force_zip64=True) as out:
                yield out

    def pack(batches):
        files, at = open_fs(folder.removeprefix("file://"))
        files.create_dir(at, recursive=True)
        task = TaskContext.get()
        temporary = f"{at}/.{task.partitionId()}-{task.taskAttemptId()}.tmp"
        name, stack = None, contextlib.ExitStack()

        def close():
            stack.close()
            if name is not None:
                files.move(temporary, f"{at}/{name}")

        for batch in batches:
            for file, line in zip(*(c.to_pylist() for c in batch.columns)):
                if file != name:
                    close()
                    name = file
                    out = stack.enter_context(writer(stack.enter_context(files.open_output_stream(temporary))))
                out.write(f"{line}{end}".encode(encoding))
        close()
        yield from ()

    ready = rows.repartition("file").sortWithinPartitions("file", *order).select("file", "raw_line")
    ready.mapInArrow(pack, "raw_line string").write.format("noop").mode("overwrite").save()


def scanned(spark: SparkSession, folder: str, **options) -> DataFrame:
    from fwloom.sources.fwf_zip import read_lines

    return read_lines(spark, folder, **options)


@query(f"SELECT {PLAIN} FROM lineitem")
def zip_scan(spark, sf_dir):
    """Lines packed into an archive for each month, read back by the data source and decoded."""
    folder = kept_dir(spark)
    lines = lineitem_lines(spark, sf_dir, False).withColumn("file", F.date_format("l_shipdate", "yyyyMM'.zip'"))
    pack_files(lines, folder, [])
    return D.good_rows(D.decode(scanned(spark, folder), LINEITEM), LINEITEM)


def named_lines(spark: SparkSession, sf_dir: str, table: str, name: str = ".zip") -> DataFrame:
    """Key and name of customers or suppliers, a file for each nation."""
    c = table[0]
    df = read(spark, sf_dir, table)
    return df.select(F.concat(F.col(f"{c}_nationkey").cast("string"), F.lit(name)).alias("file"), f"{c}_{table[:4]}key", F.concat(F.lpad(F.col(f"{c}_{table[:4]}key").cast("string"), 12, " "), F.rpad(f"{c}_name", 30, " ")).alias("raw_line"))


def names_back(lines: DataFrame) -> DataFrame:
    nation = F.regexp_extract("input_path", r"(\d+)\.\w+$", 1).cast("int").alias("nation")
    return lines.select(nation, "line_no", F.rtrim(F.substring("raw_line", 13, 30)).alias("name"), F.trim(F.substring("raw_line", 1, 12)).cast("long").alias("key"))


def names_sql(table: str) -> str:
    c, key = table[0], f"{table[0]}_{table[:4]}key"
    return f"SELECT cast({c}_nationkey as integer) AS nation, cast(row_number() OVER (PARTITION BY {c}_nationkey ORDER BY {key}) as bigint) AS line_no, rtrim({c}_name) AS name, {key} AS key FROM {table}"


def names_packed(spark: SparkSession, sf_dir: str, table: str, split_bytes: int = 1 << 27, name: str = ".zip", **how) -> DataFrame:
    folder = kept_dir(spark)
    pack_files(named_lines(spark, sf_dir, table, name), folder, [f"{table[0]}_{table[:4]}key"], **how)
    return scanned(spark, folder, split_bytes=split_bytes)


@query(names_sql("supplier"))
def zip_member_choice(spark, sf_dir):
    """Of an archive with a small member beside the data, the largest is read; lines are numbered in order."""
    return names_back(names_packed(spark, sf_dir, "supplier", notes=True))


@query(names_sql("supplier"))
def zip_line_ends(spark, sf_dir):
    """Lines that end in a carriage return and a line feed."""
    return names_back(names_packed(spark, sf_dir, "supplier", end="\r\n"))


@query(names_sql("supplier"))
def zip_lone_returns(spark, sf_dir):
    """Lines that end in a carriage return alone."""
    return names_back(names_packed(spark, sf_dir, "supplier", end="\r"))


@query(names_sql("customer"))
def fwf_range_scan(spark, sf_dir):
    """Plain files cut into ranges of a kilobyte: every line once, with its number in the file."""
    return names_back(names_packed(spark, sf_dir, "customer", 1_000, ".fwf", end="\r\n", kind="plain"))


@query(names_sql("customer"))
def zip_stored_ranges(spark, sf_dir):
    """Archives whose data are stored, cut into ranges too."""
    return names_back(names_packed(spark, sf_dir, "customer", 1_000, notes=True, kind="stored"))


@query(f"SELECT * FROM ({names_sql('customer')}) WHERE nation IN (3, 8, 21) AND line_no <= 40 OR nation = 5 AND 1 = 0")
def scan_pushdown(spark, sf_dir):
    """The heads of three files: filters on file and line number reach the source."""
    lines = names_packed(spark, sf_dir, "customer", 1_000, ".fwf", kind="plain")
    paths = [r["input_path"] for r in lines.where("line_no = 1").select("input_path").collect() if r["input_path"].rsplit("/", 1)[-1] in ("3.fwf", "8.fwf", "21.fwf")]
    return names_back(lines.where(F.col("input_path").isin(paths) & (F.col("line_no") <= 40)))


@query("SELECT cast(c_nationkey as integer) AS nation, sha256(string_agg(lpad(cast(c_custkey as varchar), 12, ' ') || rpad(c_name, 30, ' ') || chr(10), '' ORDER BY c_custkey)) AS sha256 FROM customer GROUP BY 1")
def file_hashes(spark, sf_dir):
    """Hashes of files, read by tasks."""
    from fwloom.sources.fwf_zip import files_at

    folder = kept_dir(spark)
    pack_files(named_lines(spark, sf_dir, "customer", ".fwf"), folder, ["c_custkey"], kind="plain")
    files = spark.createDataFrame([(p,) for p in files_at(folder)], "path string")
    return planning.with_hashes(files).select(F.regexp_extract("path", r"(\d+)\.\w+$", 1).cast("int").alias("nation"), "sha256")


@query(names_sql("customer").replace("rtrim(c_name) AS name", "'Müller, Zoé ' || rtrim(substr(c_name, 10)) AS name"))
def fwf_text_encoding(spark, sf_dir):
    """Archives in another encoding than UTF-8."""
    folder = kept_dir(spark)
    lines = named_lines(spark, sf_dir, "customer")
    lines = lines.withColumn("raw_line", F.concat(F.substring("raw_line", 1, 12), F.lit("Müller, Zoé "), F.substring("raw_line", 22, 18)))
    pack_files(lines, folder, ["c_custkey"], encoding="cp1252")
    return names_back(scanned(spark, folder, encoding="cp1252"))


@query("SELECT cast(c_nationkey as integer) AS nation, c_nationkey % 4 = 1 AS failed, cast(CASE WHEN c_nationkey % 4 = 1 THEN 0 ELSE count(*) END as bigint) AS n FROM customer GROUP BY 1, 2")
def zip_read_errors(spark, sf_dir):
    """Archives of some nations are in an encoding that their bytes do not follow: each fails alone, with a row that says so."""
    folder = kept_dir(spark)
    lines = named_lines(spark, sf_dir, "customer")
    broken = F.regexp_extract("file", r"^(\d+)", 1).cast("int") % 4 == 1
    pack_files(lines.where(~broken), folder, ["c_custkey"])
    pack_files(lines.where(broken).withColumn("raw_line", F.concat(F.lit("é"), "raw_line")), folder, ["c_custkey"], encoding="cp1252")
    rows = scanned(spark, folder)
    nation = F.regexp_extract("input_path", r"(\d+)\.\w+$", 1).cast("int").alias("nation")
    return rows.groupBy(nation).agg(F.max(F.col("read_error").isNotNull()).alias("failed"), F.count("raw_line").alias("n"))


@query("SELECT cast(c_nationkey as integer) AS nation, cast(count(*) as bigint) AS n, cast(sum(c_custkey) as bigint) AS keys FROM customer GROUP BY 1")
def stream_new_files(spark, sf_dir):
    """Files that come in two waves are streamed, each once, with one checkpoint."""
    from fwloom.sources.fwf_zip import FORMAT, register

    register(spark)
    drop, base = kept_dir(spark), kept_dir(spark)
    lines = named_lines(spark, sf_dir, "customer")
    for wave in (F.col("file") >= "2", F.col("file") < "2"):  # names of the second come before those of the first
        pack_files(lines.where(wave), drop, ["c_custkey"])
        stream = spark.readStream.format(FORMAT).option("path", drop).option("log", f"{base}/seen").load()
        names_back(stream).writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.schema("nation int, line_no long, name string, key long").parquet(f"{base}/out")
    return out.groupBy("nation").agg(F.count("*").alias("n"), F.sum("key").alias("keys"))


PERIODS = Layout("imports", "1990-01", "1990-01", 30, (Field("period", 1, 6, "Date", parse="yyyymm_to_date"), Field("o_orderkey", 7, 12, "Int64", False), Field("o_custkey", 19, 12, "Int64")), "period")


def ingested(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a run over orders, an archive for each year: every fiftieth row is bad, and so are all of the second half of 1995."""
    from dataclasses import replace

    from fwloom.layouts import Source
    from fwloom.plans import ingest

    orders = read(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("period"), "o_orderkey", "o_custkey")
    bad = (F.col("o_orderkey") % 50 == 3) | (F.year("period") == 1995) & (F.month("period") > 6)
    line = D.render(orders, PERIODS)
    lines = orders.select(F.date_format("period", "'S_'yyyy'12N.zip'").alias("file"), "o_orderkey", F.when(bad, F.overlay(line, F.lit("           x"), 7)).otherwise(line).alias("raw_line"))
    base = kept_dir(spark)
    pack_files(lines, f"{base}/drop", ["o_orderkey"])
    layout = replace(PERIODS, source=Source("b", "0", "S", "t", None, r"^S_(?P<year>\d{4})(?P<month>\d{2})(?P<flag>[NC])\.zip$"))
    ingest.run(spark, ingest.IngestOptions(f"{base}/drop", f"{base}/out", "", ("imports",), ytd=False, max_skip_rate=0.4, max_quality_issues=0), {"imports": [layout]})
    return base


@query("""WITH o AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderkey, o_orderkey % 50 = 3 OR year(o_orderdate) = 1995 AND month(o_orderdate) > 6 AS bad FROM orders),
n AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY o_orderkey) AS line FROM o),
c AS (SELECT *, sum(bad::int) OVER (PARTITION BY y ORDER BY line) AS bads FROM n), a AS (SELECT y, min(line) FILTER (bad AND bads / line > 0.4) AS line FROM c GROUP BY y),
g AS (SELECT y, m, count(*) FILTER (NOT bad) AS n FROM c GROUP BY 1, 2), s AS (SELECT y, count(*) FILTER (bad AND (a.line IS NULL OR c.line <= a.line)) AS skipped FROM c JOIN a USING (y) GROUP BY y)
SELECT cast(y as integer) AS year, cast(m as integer) AS month, 'ok' AS status, cast(n as bigint) AS rows_written, cast(skipped as bigint) AS rows_skipped FROM g JOIN a USING (y) JOIN s USING (y) WHERE a.line IS NULL AND n > 0
UNION ALL SELECT cast(y as integer), 12, 'failed', 0, cast(skipped as bigint) FROM a JOIN s USING (y) WHERE a.line IS NOT NULL""")
def ingest_manifest(spark, sf_dir):
    """A whole run over archives by year, one of them hopeless: the manifest that it leaves, with exact counts."""
    from fwloom.plans import ingest

    base = ingested(spark, sf_dir)
    rows = spark.read.schema(ingest.RESULT).json(f"{base}/out/_manifests/imports/*")
    return rows.select("year", "month", "status", "rows_written", "rows_skipped")


RUN_SQL = """WITH o AS (SELECT year(o_orderdate) AS y, month(o_orderdate) AS m, o_orderkey, o_orderkey % 50 = 3 OR year(o_orderdate) = 1995 AND month(o_orderdate) > 6 AS bad FROM orders),
n AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY o_orderkey) AS line FROM o),
c AS (SELECT *, sum(bad::int) OVER (PARTITION BY y ORDER BY line) AS bads FROM n), a AS (SELECT y, min(line) FILTER (bad AND bads / line > 0.4) AS line FROM c GROUP BY y)"""


@query(RUN_SQL + " SELECT cast(y as integer) AS year, cast(c.line as bigint) AS line_no, 'o_orderkey' AS \"column\", 'cannot parse ''x'' as Int64' AS error FROM c JOIN a USING (y) WHERE bad AND (a.line IS NULL OR c.line <= a.line)")
def ingest_quality_log(spark, sf_dir):
    """The log of bad rows that the run leaves: of failed files up to the line that failed them."""
    log = spark.read.schema("year int, line_no long, column string, error string").json(f"{ingested(spark, sf_dir)}/out/_quality_issues/imports/*")
    return log.select("year", "line_no", "column", "error")


@query(RUN_SQL + " SELECT cast(y as integer) AS year, cast(m as integer) AS month, cast(count(*) as bigint) AS n, cast(sum(o_orderkey) as bigint) AS keys FROM c JOIN a USING (y) WHERE a.line IS NULL AND NOT bad GROUP BY 1, 2")
def ingest_table(spark, sf_dir):
    """The table that the run leaves: good rows of good files, by month."""
    from fwloom.plans import sinks

    rows = sinks.read_partitions(spark, f"{ingested(spark, sf_dir)}/out/imports")
    return rows.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))
