import datetime as dt
import math
import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from fwloom.functions import fields as X
from fwloom.layouts import Computed, Field, Layout
from fwloom.operators import decode as D
from fwloom.operators import quality

DATE = Layout("imports", "2020-01", "2020-01", 13, (Field("ref", 1, 5, "Utf8", False), Field("entry", 6, 8, "Date")), "entry")


def lines(spark, *rows, path="f"):
    return spark.createDataFrame([(path, n, r) for n, r in enumerate(rows, 1)], "input_path string, line_no long, raw_line string")


def test_dates_and_blanks(spark):
    out = D.good_rows(D.decode(lines(spark, "AAAAA20240115", "  BB 20240229", "CCCCC        "), DATE), DATE).collect()
    assert [tuple(r) for r in out] == [("AAAAA", dt.date(2024, 1, 15)), ("  BB", dt.date(2024, 2, 29)), ("CCCCC", None)]


def test_first_error_and_structure(spark):
    layout = Layout("imports", "2020-01", "2020-01", 20, (Field("day", 1, 8, "Date"), Field("a", 9, 5, "Int64", False), Field("b", 14, 5, "Float64")), "day")
    rows = D.decode(lines(spark, "20240101   12  1.5  ", "2024010X   12  xx   ", "20240101       1.5", "20240101   12  1.5", "20240101", "x" * 21), layout).orderBy("line_no").collect()
    assert [r["error"] and r["error"]["column"] for r in rows] == [None, "day", "a", None, None, None]
    assert rows[2]["error"]["message"] == "blank value in non-nullable column"
    assert [bool(r["structural"]) for r in rows] == [False] * 4 + [True] * 2


def test_coerce(spark):
    layout = replace(DATE, columns=(DATE.columns[0], replace(DATE.columns[1], coerce_invalid_to_null=True)))
    decoded = D.decode(lines(spark, "AAAAA20240115", "BBBBB00000000", "CCCCC99999999", "DDDDD        "), layout)
    assert [r["entry"] for r in D.good_rows(decoded, layout).collect()] == [dt.date(2024, 1, 15), None, None, None]
    assert [(r["column"], r["n"]) for r in quality.coerced_counts(decoded).collect()] == [("entry", 2)]


def test_computed(spark):
    layout = Layout("imports", "2020-01", "2020-01", 28, (Field("period", 1, 6, "Date", parse="yyyymm_to_date"), Field("day", 7, 2, "Int64"), Field("first", 9, 10, "Utf8"), Field("last", 19, 10, "Utf8")), "period", computed_columns=(Computed("on", "Date", "concat_to_date", ("period", "day")), Computed("name", "Utf8", "concat_text", ("first", "last"))), dropped_columns=("day", "first", "last"))
    rows = D.decode(lines(spark, "20240115Ada       Lovelace  ", "20240230Grace\t    Hopper    ", "202402  " + " " * 10 + "Turing    ", "20240201" + " " * 20), layout).orderBy("line_no").collect()
    assert [r["row"]["name"] for r in rows] == ["Ada Lovelace", "Grace Hopper", "Turing", None]
    assert [r["row"]["on"] for r in rows] == [dt.date(2024, 1, 15), None, None, dt.date(2024, 2, 1)]
    assert [r["error"] and r["error"]["column"] for r in rows] == [None, "on", None, None]


@pytest.mark.parametrize("dtype", ["Int64", "Float64", "yyyymmdd_to_date", "yyyymm_to_date", "Utf8"])
def test_parsers_agree_with_python(spark, dtype):
    random.seed(dtype)
    alphabet = "0123456789" * 3 + " .-+eE\t naifN" if "date" not in dtype else "012" * 4 + "3456789 "
    texts = ["".join(random.choice(alphabet) for _ in range(random.randint(0, 9))) for _ in range(4000)]
    if "date" in dtype:
        texts += [f"{random.randint(1, 9999):04d}{random.randint(0, 13):02d}{random.randint(0, 32):02d}"[: 8 if "dd" in dtype else 6] for _ in range(2000)]
    field = Field("x", 1, 30, "Date" if "date" in dtype else dtype, parse=dtype if "date" in dtype else None)
    read = {"Int64": int, "Float64": float, "Utf8": str.rstrip, "yyyymmdd_to_date": lambda s: dt.datetime.strptime(s, "%Y%m%d").date(), "yyyymm_to_date": lambda s: dt.datetime.strptime(s, "%Y%m").date()}[dtype]

    def expected(s):
        s = s if dtype == "Utf8" else s.strip()
        if not s.strip():
            return None
        try:
            return read(s)
        except ValueError:
            return None

    df = spark.createDataFrame([(t,) for t in texts], "raw_line string")
    step = df.withColumn("t", X.text_of(F.col("raw_line"), field))
    for r in step.select("raw_line", X.value_of(F.col("t"), field).alias("v")).collect():
        want = expected(r["raw_line"])
        assert r["v"] == want or (isinstance(want, float) and math.isnan(want) and math.isnan(r["v"])), r


def test_decode_stays_in_the_jvm(spark):
    plan = D.good_rows(D.decode(lines(spark, "AAAAA20240115"), DATE), DATE)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_verdicts(spark):
    bad = [n in (1, 5, 6) for n in range(1, 21)]
    rows = lines(spark, *("AAAAA2024XX15" if b else "AAAAA20240115" for b in bad))
    found = quality.issues(D.decode(rows, DATE), "entry", F.lit(2024), F.lit(12))
    assert quality.verdicts(found, max_skip_rate=0.5).first()["abort_line"] == 1
    assert quality.verdicts(found, max_skip_rate=1.0).count() == 0
    assert quality.verdicts(found, max_issues=2).first()["abort_line"] == 6
    kept = quality.logged(found, quality.verdicts(found, max_issues=2), 2)
    assert sorted(r["line_no"] for r in kept.collect()) == [1, 5]


def test_routing(spark):
    rows = lines(spark, "AAAAA20240115", "AAAAA20240315", "AAAAA20230115", "AAAAA        ")
    found = quality.issues(D.decode(rows, DATE), "entry", F.lit(2024), F.lit(2)).orderBy("line_no").collect()
    assert [r["line_no"] for r in found] == [2, 3, 4]
    assert "outside the snapshot window (2024-01..2024-02)" in found[0]["message"] and "null" in found[2]["message"]
