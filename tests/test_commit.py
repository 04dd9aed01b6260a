"""Judging by passes, exact counts, and months that are switched all or none."""

import pytest
from pyspark.sql import functions as F

from fwloom import cli, storage
from fwloom.operators import discovery, planning, quality
from fwloom.plans import ingest, sinks
from tests.test_ingest import LAYOUT, counts, drop, env, line, options  # noqa: F401


def judged(spark, env, lines, **more):  # noqa: F811
    drop(env / "in", "Sheet_202403N.TXT.zip", lines)
    files = [r.asDict() for r in ingest.select_inputs(spark, options(env), {"imports": [LAYOUT]}).collect()]
    with storage.scratch(spark) as folder:
        got = ingest.judge(spark, options(env, **more), LAYOUT, files, folder)
        return got, [tuple(r) for r in got.failed.collect()], got.issues.count()


def test_hopeless_files_cost_a_few_thousand_lines(spark, env):  # noqa: F811
    bad = [line("202401", n, "X" if n > 600 else n) for n in range(60_000)]
    got, failed, _ = judged(spark, env, bad)
    assert [f[1] for f in failed] == [1203] and set(got.read.values()) == {ingest.PROBES[0]}
    # The verdict is that of a whole reading.
    found = quality.issues(ingest.decoded_files(spark, options(env), LAYOUT, [{"path": failed[0][0], "year": 2024, "month": 3}], None), "period", F.col("file_year"), F.col("file_month"))
    assert [r["abort_line"] for r in quality.verdicts(found, 0.5).collect()] == [1203]


def test_passes_grow_until_a_file_is_settled(spark, env, monkeypatch):  # noqa: F811
    monkeypatch.setattr(ingest, "PROBES", (10, 100))
    rows = [line("202401", n) for n in range(500)]
    got, failed, _ = judged(spark, env, rows)
    assert failed == [] and set(got.read.values()) == {10 + 100 + 500} and set(got.lines.values()) == {500}
    got, failed, _ = judged(spark, env, rows[:60] + [line("202401", n, "X") for n in range(440)])
    assert [f[1] for f in failed] == [121] and set(got.read.values()) == {610}
    got, failed, _ = judged(spark, env, rows[:5])
    assert failed == [] and set(got.read.values()) == {5}
    got, failed, _ = judged(spark, env, rows[:99] + ["short"])
    assert [f[1] for f in failed] == [100] and set(got.read.values()) == {110}


def brute_batches(kinds, rate, chunk, by_batch):
    """The line at which a file fails: kinds are g(ood), b(ad), o(utside)."""
    bad = out = good = 0
    pending = 0
    for n, k in enumerate(kinds, 1):
        if k == "b":
            bad += 1
            if bad / n > rate:
                return n
            continue
        good += 1
        pending += k == "o"
        if good % chunk == 0:
            out, pending = out + pending, 0
            if by_batch and (bad + out) / n > rate:
                return n
    if by_batch and good % chunk and (bad + out + pending) / len(kinds) > rate:
        return len(kinds)
    return None


def test_batch_rule_equals_brute_force(spark):
    import random

    rng = random.Random(3)
    files = {f"f{n}": "".join(rng.choices("gbo", [4, rng.random() * 2, rng.random() * 4], k=rng.choice([1, 3, 12, 40, 41]))) for n in range(300)}
    files |= {"tail": "g" * 10 + "b" * 9, "none": "o" * 10, "exact": "g" * 5 + "o" * 5}
    rows = [(f, n, "c", "m", "raw", False, k == "b") for f, kinds in files.items() for n, k in enumerate(kinds, 1) if k != "g"]
    found = spark.createDataFrame(rows, "input_path string, line_no long, column string, message string, raw_line string, structural boolean, row_error boolean")
    totals = spark.createDataFrame([(f, len(k), True) for f, k in files.items()], "input_path string, lines long, whole boolean")
    for rate, chunk in ((0.5, 5), (0.3, 4), (0.6, 1), (0.4, 1000)):
        got = {r["input_path"]: r["abort_line"] for r in quality.verdicts(found, rate, batch_rows=chunk, totals=totals).collect()}
        assert got == {f: n for f, k in files.items() if (n := brute_batches(k, rate, chunk, True)) is not None}
        # The first lines alone never say more than the whole file.
        first = totals.select("input_path", F.least(F.lit(9), "lines").cast("long").alias("lines"), (F.col("lines") < 9).alias("whole"))
        early = {r["input_path"]: r["abort_line"] for r in quality.verdicts(found.where("line_no <= 9"), rate, batch_rows=chunk, totals=first).collect()}
        assert all(got[f] == n for f, n in early.items()) and {f for f, n in got.items() if n < 9} <= early.keys()


def test_both_rules_in_a_run(spark, env):  # noqa: F811
    rows = [line("202401" if n < 40 else "202307", n) for n in range(100)]
    drop(env / "in", "Sheet_202403N.TXT.zip", rows)
    # Row by row the share of other months never passes a half before the last lines; by batches it does at their ends.
    assert "line 100" in ingest.run(spark, options(env)).results[0]["error"]
    assert "line 81" in ingest.run(spark, options(env, skip_rule="every")).results[0]["error"]
    assert "line 90" in ingest.run(spark, options(env, batch_rows=30)).results[0]["error"]
    assert ingest.run(spark, options(env, max_skip_rate=0.7)).failed_count == 0


def test_counts_are_exact_within_a_second(spark, env, monkeypatch):  # noqa: F811
    """Two runs at one moment, the second with fewer rows: counts come from what a run staged."""
    assert ingest.run(spark, options(env)).total_rows == 24
    drop(env / "in", "Sheet_202402N.TXT.zip", [line("202402", n) for n in range(5)])
    second = ingest.run(spark, options(env))
    assert [(r["month"], r["rows_written"]) for r in second.results] == [(2, 5)]
    assert counts(spark, env) == {(2024, 1): 12, (2024, 2): 5}


@pytest.mark.parametrize("moves", range(5))
def test_switch_is_all_or_none(spark, tmp_path, monkeypatch, moves):
    path = str(tmp_path / "t")
    rows = lambda n: spark.range(40).select(F.to_date(F.concat(F.lit("2024-"), (F.col("id") % 2 + 1).cast("string"), F.lit("-1"))).alias("day"), F.lit(n).alias("n"))
    sinks.write_partitions(rows(1), "day", path)
    sinks.stage_partitions(rows(2), "day", path, "lost")
    before = storage.Folders.move
    left = [moves]

    def move(self, a, b):
        if not left[0]:
            raise KeyboardInterrupt  # the driver is lost here
        left[0] -= 1
        before(self, a, b)

    monkeypatch.setattr(storage.Folders, "move", move)
    if moves < 4:
        with pytest.raises(KeyboardInterrupt):
            sinks.switch(spark, path, "lost")
    else:
        sinks.switch(spark, path, "lost")
    monkeypatch.setattr(storage.Folders, "move", before)
    assert sinks.recover(spark, path) == ["lost"] * (moves < 4)
    assert {(r["n"], r["count"]) for r in sinks.read_partitions(spark, path).groupBy("n").count().collect()} == {(2, 40)}
    assert sorted(x.name for x in (tmp_path / "t").iterdir() if x.name.startswith("_")) in (["_journal"], [])


def test_a_run_lost_before_its_switch_leaves_the_old_months(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10).select(F.lit("2024-01-01").cast("date").alias("day"), "id")
    sinks.write_partitions(rows, "day", path)
    sinks.stage_partitions(rows.where("id > 5"), "day", path, "lost")
    assert sinks.read_partitions(spark, path).count() == 10
    assert sinks.recover(spark, path) == [] and sinks.read_partitions(spark, path).count() == 10
    assert not (tmp_path / "t" / sinks.STAGING).exists()
    sinks.write_partitions(rows.where("id < 0"), "day", path)
    assert sinks.read_partitions(spark, path).count() == 10


def test_equal_rows_keep_their_version(spark):
    versions = spark.createDataFrame([("t", "v1", "2020-01", None)], "trade_type string, version string, effective_from string, effective_to string")
    found = spark.createDataFrame([("t", "2020-05"), ("t", "2020-05"), ("t", "2019-01"), ("u", "2020-05"), ("t", None)], "trade_type string, period string")
    assert sorted(map(tuple, discovery.resolve(found, versions).collect()), key=str) == sorted([("t", "2020-05", "v1"), ("t", "2020-05", "v1"), ("t", "2019-01", None), ("u", "2020-05", None), ("t", None, None)], key=str)


def test_volume_and_totals(spark):
    assert tuple(planning.volume(spark.createDataFrame([("a", 3), ("b", None)], "name string, size long")).first()) == (2, 3)
    results = [("a", "ok", 5, 2, {"x": 3, "y": 1}), ("a", "ok", 6, 2, {"x": 3, "y": 1}), ("b", "failed", 0, 1, {}), ("c", "ok", 0, 0, None)]
    df = spark.createDataFrame(results, "input_path string, status string, rows_written long, rows_skipped long, coerced_counts map<string,long>")
    summary = ingest.RunSummary("r", [dict(zip(("input_path", "status", "rows_written", "rows_skipped", "coerced_counts"), (*r[:4], r[4] or {}))) for r in results])
    assert tuple(quality.run_totals(df).first()) == (summary.ok_count, summary.failed_count, summary.total_rows, summary.total_skipped, summary.total_coerced) == (3, 1, 11, 5, 4)


def test_fail_fast_on_the_command_line(spark, env, capsys, monkeypatch):  # noqa: F811
    monkeypatch.setattr(cli, "session", lambda: spark)
    drop(env / "in", "Sheet_202402N.TXT.zip", [line("202402", n, "x" if n == 5 else None) for n in range(12)])
    args = ["ingest", "--input", str(env / "in"), "--output", str(env / "out"), "--spec-dir", str(env / "specs"), "--current-year", "2024"]
    assert cli.main([*args, "--fail-fast"]) == 1 and "line 6, column value" in capsys.readouterr().err
    assert cli.main(args) == 0


def test_periodic_job_over_file_uris(spark, tmp_path):
    """Listings, manifests, outputs and hashes go through file systems, not through local paths."""
    from fwloom.plans import cycle
    from tests.test_catalog_and_cycle import ROWS, book, project

    for d in ("books", "raw", "specs", "out", "manifests"):
        (tmp_path / d).mkdir()
    book(tmp_path / "books" / "b_2020.xlsx", {"Sheet": ROWS})
    project(tmp_path / "project.yaml")
    drop(tmp_path / "raw", "Sheet_202401N.TXT.zip", [line("202401", n) for n in range(4)])
    uri = lambda d: f"file://{tmp_path / d}"
    settings = cycle.Settings(str(tmp_path / "project.yaml"), str(tmp_path / "books"), uri("raw"), str(tmp_path / "specs"), uri("out"), uri("manifests"))
    assert cycle.run(spark, settings) == 0
    files = cycle.raw_files(spark, settings)
    assert [tuple(r) for r in files.select("name", "output_present", "size").collect()] == [("Sheet_202401N.TXT.zip", True, (tmp_path / "raw" / "Sheet_202401N.TXT.zip").stat().st_size)]
    runs = lambda: len(list((tmp_path / "out/_manifests/imports").iterdir()))
    assert runs() == 1 and cycle.run(spark, settings) == 0 and runs() == 1
    assert sinks.read_partitions(spark, uri("out/imports")).count() == 4
