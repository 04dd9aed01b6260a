import math
import random
from dataclasses import replace

import pyarrow as pa
import pytest

from fwloom.functions import table as T
from fwloom.layouts import Field
from fwloom.operators import decode as D
from tests.test_table_function import LAYOUT, random_line

ODD = {
    "Int64": ["0", "-0", "+5", "007", "-9", "999999999999999999", "9223372036854775807", "-9223372036854775808", "9223372036854775808", "0x1F", "1_000", "1 0", "1.0", "-", "+", "--1", "１２", "1e3", "1\n2", "12\x00", "1\t", "\xa07"],
    "Float64": ["0", "-0", "-0.00", "1.", ".5", "+.5e-3", "0.1", "123456789012345.123456789012345", "1234567890123456789", "4.35", "2.675", "1e400", "1e-400", "inf", "-Infinity", "nan", "infi", "0x1", "1,5", "1_0", ".", "e5", "１.5"],
    "Date": ["20240229", "20230229", "00000101", "00010101", "99991231", "20241301", "20240001", "20240100", "20240132", "2024 1 5", "202415", "2024105", "19700101", "19691231", "15821010", "２０２４0101", "-2024010"],
}


def one_by_one(text, field):
    """What the readers of single values say, and whether the row is lost."""
    read = {"Int64": T.read_long, "Float64": T.read_double, "Date": T.read_date(field.parse or "yyyymmdd_to_date")}[field.dtype]
    try:
        value = read(text) if text else None
    except T.Bad:
        return None, not field.coerce_invalid_to_null
    return value, value is None and not field.nullable


@pytest.mark.parametrize("dtype,parse", [("Int64", None), ("Float64", None), ("Date", None), ("Date", "yyyymm_to_date")])
def test_columns_are_read_as_single_values_are(dtype, parse):
    rng = random.Random(3)
    texts = ODD[dtype] + [t[:6] for t in ODD["Date"] if dtype == "Date"] + ["", ""] + ["".join(rng.choice("0123456789.-+ex ") for _ in range(rng.randrange(1, 9))) for _ in range(3000)]
    texts += [f"{rng.randrange(1, 2100):04d}{rng.randrange(14):02d}{rng.randrange(33):02d}"[: 6 if parse else 8] for _ in range(3000)]
    for field in (Field("v", 1, 40, dtype, parse=parse), Field("v", 1, 40, dtype, False, parse), Field("v", 1, 40, dtype, parse=parse, coerce_invalid_to_null=True)):
        lines = pa.array([f"{t:<40}" for t in texts], pa.string())
        values, spoilt = T.column_of(T.texts_of(lines, field, False), field)
        want = [one_by_one(t.strip(), field) for t in texts]
        assert spoilt.to_pylist() == [lost for _, lost in want]
        assert [str(v) for v in values.to_pylist()] == [str(v) for v, _ in want]
        assert any(lost for _, lost in want) or field.coerce_invalid_to_null
    signs = [math.copysign(1, v) for v in T.column_of(pa.array(["-0", "-0.00", "0"]), Field("v", 1, 9, "Float64"))[0].to_pylist()]
    assert signs == [-1, -1, 1]


def test_cuts_of_plain_lines_are_those_of_any():
    rng = random.Random(4)
    lines = pa.array([line for line in (random_line(rng) for _ in range(4000)) if line.isascii() and len(line) >= 41] + [" \x1c\x85"[:2] * 30], pa.string())
    for field in LAYOUT.fields:
        assert T.texts_of(lines, field, True).equals(T.texts_of(lines, field, False))


def test_function_takes_and_gives_batches():
    rng = random.Random(5)
    texts = [random_line(rng) for _ in range(2 * T.BATCH + 5)] + [None]
    lines = pa.record_batch({"line_no": list(range(len(texts))), "raw_line": texts})
    found = list(T.table_function({"imports": LAYOUT}).func().eval(lines, pa.array(["imports"] * len(texts))))
    assert len(found) == 3 and all(isinstance(t, pa.Table) for t in found)
    one = T.decode_batch(pa.array(texts, pa.string()), LAYOUT)
    assert str(pa.concat_tables(found).to_pylist()) == str(one.to_pylist()) and one.num_rows > 300


def test_function_with_other_columns_partitions_and_settings(spark):
    rng = random.Random(6)
    plain = replace(LAYOUT, computed_columns=(), dropped_columns=())
    rows = [(n % 3, "f", n, random_line(rng)) for n in range(3000)]
    lines = spark.createDataFrame(rows, "part long, input_path string, line_no long, raw_line string").repartition(2)
    lines.createOrReplaceTempView("other_lines")
    T.register(spark, {"imports": LAYOUT, "plain": plain})
    for name, layout in (("imports", LAYOUT), ("plain", plain)):
        want = sorted(map(str, D.good_rows(D.decode(lines, layout), layout).collect()))
        assert len(want) > 100
        calls = [f"TABLE(other_lines), '{name}'", f"layout => '{name}', lines => TABLE(other_lines)", f"TABLE(other_lines) PARTITION BY (part), '{name}'", f"TABLE(other_lines) PARTITION BY (part + 1) ORDER BY (line_no), '{name}'", f"TABLE(other_lines) PARTITION BY (raw_line), '{name}'", f"TABLE(other_lines) WITH SINGLE PARTITION, '{name}'"]
        for call in calls:
            assert sorted(map(str, spark.sql(f"SELECT * FROM fwf_decode({call})").collect())) == want
        for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "7"), ("spark.sql.execution.arrow.maxRecordsPerBatch", "0"), ("spark.sql.execution.arrow.useLargeVarTypes", "true")):
            spark.conf.set(key, value)
            try:
                assert sorted(map(str, spark.sql(f"SELECT * FROM fwf_decode({calls[0]})").collect())) == want
            finally:
                spark.conf.unset(key)
