import datetime as dt
import json
import zipfile

import pytest

from fwloom import layouts as L
from fwloom.layouts import Field, Layout, Source
from fwloom.operators import discovery
from fwloom.plans import ingest, sinks
from fwloom.sources.fwf_zip import FORMAT, FwfZip
from fwloom.streaming import ingest as stream

PATTERN = r"^Sheet_(?P<year>\d{4})(?P<month>\d{2})(?P<flag>[NC])\.TXT\.zip$"
LAYOUT = Layout("imports", "2020-01", "2020-01", 24, (Field("period", 1, 6, "Date", False, "yyyymm_to_date"), Field("code", 7, 8, "Utf8"), Field("value", 15, 10, "Int64", False)), source=Source("b", "0", "Sheet", "t", None, PATTERN))


def line(period, n, value=None):
    return f"{period}{'c' + str(n):<8}{n if value is None else value:>10}"


def drop(folder, name, lines, codec="utf-8"):
    folder.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(folder / name, "w") as z:
        z.writestr("readme.txt", "x")
        z.writestr("data.fwf", "\n".join(lines).encode(codec) + b"\n")


@pytest.fixture
def env(tmp_path):
    L.save(LAYOUT, tmp_path / "specs" / "imports" / "v2020-01.yaml")
    drop(tmp_path / "in", "Sheet_202402N.TXT.zip", [line(p, n) for p in ("202401", "202402") for n in range(12)])
    drop(tmp_path / "in", "Sheet_202401N.TXT.zip", [line("202401", n) for n in range(12)])
    drop(tmp_path / "in", "Sheet_202312N.TXT.zip", [line("202312", n) for n in range(12)])
    return tmp_path


def options(env, **more):
    return ingest.IngestOptions(str(env / "in"), str(env / "out"), str(env / "specs"), ("imports",), **({"current_year": 2024} | more))


def counts(spark, env):
    return {(r["year"], r["month"]): r["rows"] for r in sinks.partition_counts(sinks.read_partitions(spark, str(env / "out" / "imports"))).collect()}


def test_year_to_date_and_rerun(spark, env):
    summary = ingest.run(spark, options(env))
    assert [(r["year"], r["month"], r["rows_written"], r["status"]) for r in summary.results] == [(2024, 1, 12, "ok"), (2024, 2, 12, "ok")]
    assert summary.total_rows == 24
    assert counts(spark, env) == {(2024, 1): 12, (2024, 2): 12}
    assert (env / "out/imports/year=2024/month=01").is_dir()
    ingest.run(spark, options(env))
    assert counts(spark, env) == {(2024, 1): 12, (2024, 2): 12}
    assert len(list((env / "out/_manifests/imports").iterdir())) == 2
    schema = json.loads((env / "out/imports/_dataset_schema.json").read_text())
    assert [c["name"] for c in schema["columns"]] == ["period", "code", "value"]


def test_all_years_and_other_months_stay(spark, env):
    assert ingest.run(spark, options(env, ytd=False)).ok_count == 3
    drop(env / "in", "Sheet_202403N.TXT.zip", [line("202403", n) for n in range(5)])
    ingest.run(spark, options(env))
    assert counts(spark, env) == {(2024, 1): 12, (2024, 2): 12, (2024, 3): 5, (2023, 12): 12}


def test_bad_rows_are_logged(spark, env):
    drop(env / "in", "Sheet_202403N.TXT.zip", [*(line("202403", n) for n in range(9)), line("202403", 9, "ABCDE"), line("202305", 10), line("202404", 11)])
    summary = ingest.run(spark, options(env))
    assert [(r["month"], r["rows_written"], r["rows_skipped"]) for r in summary.results] == [(3, 9, 3)]
    log = spark.read.json(str(env / "out/_quality_issues/imports/*")).orderBy("line_no").collect()
    assert [(r["line_no"], r["column"]) for r in log] == [(10, "value"), (11, "period"), (12, "period")]


def test_failures_stay_apart(spark, env):
    drop(env / "in", "Sheet_202403N.TXT.zip", [line("202403", 1), "short"])
    (env / "in" / "Sheet_202212N.TXT.zip").write_bytes(b"PK no archive")
    drop(env / "in", "Sheet_201912N.TXT.zip", [line("201912", 1)])
    summary = ingest.run(spark, options(env, ytd=False))
    by_year = {r["year"]: r for r in summary.results}
    assert {y: r["status"] for y, r in by_year.items()} == {2019: "failed", 2022: "failed", 2023: "ok", 2024: "failed"}
    assert "truncated" in by_year[2024]["error"] and "no layout applies" in by_year[2019]["error"]


def test_skip_rate_and_cap(spark, env):
    drop(env / "in", "Sheet_202403N.TXT.zip", [line("202403", n, "X" if n % 3 == 1 else n) for n in range(30)])
    assert ingest.run(spark, options(env, max_skip_rate=0.4)).failed_count == 1
    assert ingest.run(spark, options(env, max_skip_rate=1.0)).failed_count == 0
    assert "quality issues" in ingest.run(spark, options(env, max_skip_rate=1.0, max_quality_issues=3)).results[0]["error"]


def test_fail_fast_names_the_first_bad_row(spark, env):
    drop(env / "in", "Sheet_202402N.TXT.zip", [line("202402", n, "x" if n in (5, 8) else None) for n in range(12)])
    with pytest.raises(ingest.BadRow, match=r"Sheet_202402N.TXT.zip line 6, column value: "):
        ingest.run(spark, options(env, fail_fast=True))
    assert not (env / "out" / "imports").exists()
    assert ingest.run(spark, options(env)).failed_count == 0


def test_flags_and_unknown_types(spark, env):
    drop(env / "in", "Sheet_202402C.TXT.zip", [line("202402", 99)])
    chosen = ingest.select_inputs(spark, options(env), {"imports": [LAYOUT]}).collect()
    assert [(r["month"], r["flag"]) for r in chosen] == [(2, "N")]
    with pytest.raises(discovery.DiscoveryError):
        ingest.run(spark, ingest.IngestOptions(str(env / "in"), "x", str(env / "specs"), ("other",)))


def test_source(spark, tmp_path):
    spark.dataSource.register(FwfZip)
    drop(tmp_path, "a.zip", ["é1", "b"], "cp1252")
    (tmp_path / "plain.fwf").write_bytes(b"x\r\ny\rz\x0bw\n\nlast")
    with zipfile.ZipFile(tmp_path / "empty.zip", "w"):
        pass
    read = lambda **o: spark.read.format(FORMAT).options(**o).load(str(tmp_path)).orderBy("input_path", "line_no").collect()
    rows = read(encoding="cp1252")
    assert [r["raw_line"] for r in rows if "a.zip" in r["input_path"]] == ["é1", "b"]
    assert [(r["line_no"], r["raw_line"]) for r in rows if "plain" in r["input_path"]] == [(1, "x"), (2, "y"), (3, "z\x0bw"), (4, ""), (5, "last")]
    assert [r["read_error"] for r in rows if "empty" in r["input_path"]][0].endswith("zip is empty")
    assert any("cannot decode" in (r["read_error"] or "") for r in read(encoding="utf-8"))
    assert max(r["line_no"] for r in read(encoding="cp1252", maxLines="2")) == 2


def test_stream(spark, env):
    q = stream.start(spark, options(env), str(env / "check"))
    q.awaitTermination(120)
    assert counts(spark, env) == {(2024, 1): 12, (2024, 2): 12, (2023, 12): 12}
    drop(env / "in", "Sheet_202403N.TXT.zip", [line("202403", n) for n in range(3)])
    q = stream.start(spark, options(env), str(env / "check"))
    q.awaitTermination(120)
    assert counts(spark, env)[2024, 3] == 3


def test_hive_layout_prunes(spark, env):
    ingest.run(spark, options(env))
    plan = sinks.read_partitions(spark, str(env / "out/imports")).where("year = 2024 AND month = 1 AND value > 3")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "GreaterThan(value,3)" in plan
    assert dt.date(2024, 1, 1) == sinks.read_partitions(spark, str(env / "out/imports")).agg({"period": "min"}).first()[0]
