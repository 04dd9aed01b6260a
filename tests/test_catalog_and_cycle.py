import os
import zipfile
from dataclasses import replace

import pytest
import yaml

from fwloom import cli
from fwloom import layouts as L
from fwloom.config import ConfigError, load_config
from fwloom.operators import catalog
from fwloom.plans import compile as C
from fwloom.plans import cycle
from fwloom.sources import workbook as W
from tests.test_ingest import LAYOUT, PATTERN, drop, line

ROWS = [["Layout of things"], [], ["Position", "Description", "Length", "Type", "Nullable", "Parse"], [1, "period", 6, "Char", "N"], [7, "code", 8, "Char", "Y"], [15, "Blank", 0, "Char"], [15, "value", "10.0", "Num", "no"], [30, None, None], ["see notes"]]


def book(path, sheets):
    """A minimal .xlsx file."""
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    cell = lambda v: "<c/>" if v is None else f"<c><v>{v}</v></c>" if isinstance(v, (int, float)) else f'<c t="inlineStr"><is><t>{v}</t></is></c>'
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("xl/workbook.xml", f"<workbook {ns}><sheets>" + "".join(f'<sheet name="{n}" r:id="r{i}"/>' for i, n in enumerate(sheets)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="r{i}" Target="worksheets/s{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        for i, rows in enumerate(sheets.values()):
            z.writestr(f"xl/worksheets/s{i}.xml", f"<worksheet {ns}><sheetData>" + "".join("<row>" + "".join(map(cell, r)) + "</row>" for r in rows) + "</sheetData></worksheet>")


def project(path, **sheet):
    own = {"trade_type": "imports", "filename_pattern": PATTERN, "cast": {"period": "Date"}, "parse": {"period": "yyyymm_to_date"}} | sheet
    path.write_text(yaml.safe_dump({"workbooks": {"b_2020.xlsx": {"effective_from": "2020-01", "sheets": {"Sheet": own}}}}))
    return load_config(path)


def test_workbook(tmp_path):
    book(tmp_path / "b_2020.xlsx", {"Sheet": ROWS})
    config = project(tmp_path / "p.yaml", rename={"value": "amount"}, drop=["code"])
    layout = W.compile_workbook(tmp_path / "b_2020.xlsx", config.workbooks["b_2020.xlsx"])["imports"]
    assert [(f.physical_name, f.start, f.length, f.dtype, f.nullable) for f in layout.fields] == [("period", 1, 6, "Date", False), ("code", 7, 8, "Utf8", True), ("value", 15, 10, "Int64", False)]
    assert layout.record_length == 30 and layout.source.workbook_id == "b" and [c.name for c in layout.outputs] == ["period", "amount"]
    with pytest.raises(L.LayoutError, match="did you mean 'value'"):
        W.configured(list(layout.columns), project(tmp_path / "p.yaml", rename={"valu": "x"}).workbooks["b_2020.xlsx"].sheets["Sheet"])
    with pytest.raises(L.LayoutError, match="unknown column type"):
        W.dtype_of("blob")


@pytest.mark.parametrize("bad", [{"trade_type": "x"}, {"cast": {"a": "Decimal"}}, {"parse": {"a": "x"}}, {"drop": ["a", "a"]}, {"drop": "a"}, {"rename": {"a": "c", "b": "c"}}, {"filename_pattern": "("}, {"computed": {"c": {"kind": "x", "sources": ["a"]}}}])
def test_config_rejects(tmp_path, bad):
    with pytest.raises(ConfigError):
        project(tmp_path / "p.yaml", **bad)


def test_diff_union_lint(spark):
    new = replace(LAYOUT, version="2024-01", effective_from="2024-01", columns=(LAYOUT.columns[0], replace(LAYOUT.columns[1], length=7), L.Field("extra", 25, 2, "Utf8", False)), record_length=26)
    assert C.diff_lines(spark, LAYOUT, new) == ["+ extra: Utf8", "~ code: Utf8/8 -> Utf8/7", "- value: Int64"]
    assert C.diff_lines(spark, LAYOUT, LAYOUT) == ["no column changes"]
    merged = catalog.union_columns(catalog.columns_of(spark, [LAYOUT, new])).collect()
    assert [(r["name"], r["nullable"]) for r in merged] == [("period", False), ("code", True), ("value", False), ("extra", False)]
    with pytest.raises(L.LayoutError, match="different dtypes"):
        catalog.union_columns(catalog.columns_of(spark, [LAYOUT, replace(new, columns=(*LAYOUT.columns[:2], replace(LAYOUT.columns[2], dtype="Utf8")))]))


def test_cycle(spark, tmp_path):
    for d in ("books", "raw", "specs", "out", "manifests"):
        (tmp_path / d).mkdir()
    book(tmp_path / "books" / "b_2020.xlsx", {"Sheet": ROWS})
    project(tmp_path / "project.yaml")
    drop(tmp_path / "upstream", "Sheet_202301N.TXT.zip", [line("202301", n) for n in range(3)])
    drop(tmp_path / "upstream", "Sheet_202401N.TXT.zip", [line("202401", n) for n in range(4)])
    settings = cycle.Settings(str(tmp_path / "project.yaml"), *(str(tmp_path / d) for d in ("books", "raw", "specs", "out", "manifests", "upstream")))
    assert cycle.run(spark, settings) == 0
    assert spark.read.parquet(str(tmp_path / "out" / "imports")).count() == 7
    runs = lambda: len(list((tmp_path / "out/_manifests/imports").iterdir()))
    assert runs() == 2
    assert cycle.run(spark, settings) == 0 and runs() == 2
    drop(tmp_path / "upstream", "Sheet_202401N.TXT.zip", [line("202401", n) for n in range(5)])
    later = os.stat(tmp_path / "upstream" / "Sheet_202401N.TXT.zip").st_mtime + 60
    os.utime(tmp_path / "upstream" / "Sheet_202401N.TXT.zip", (later, later))
    assert cycle.run(spark, settings, only=[("imports", 2023)]) == 0 and runs() == 2
    assert cycle.run(spark, settings) == 0 and runs() == 3
    assert spark.read.parquet(str(tmp_path / "out" / "imports")).count() == 8


def test_settings(tmp_path, monkeypatch):
    path = tmp_path / "c.yaml"
    path.write_text(yaml.safe_dump({k: k for k in ("project_yaml", "workbooks_dir", "raw_dir", "layouts_dir", "processed_dir")}))
    with pytest.raises(cycle.SettingsError, match="manifests_dir"):
        cycle.load_settings(path)
    monkeypatch.setenv("FWLOOM_MANIFESTS_DIR", "m")
    assert cycle.load_settings(path).manifests_dir == "m" and cycle.load_settings(path).encoding == "utf-8"


def test_mirror(tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.zip").write_text("1")
    (tmp_path / "a" / "y.txt").write_text("1")
    assert cycle.mirror(str(tmp_path / "a"), str(tmp_path / "b"), ("*.zip",)) == 1
    assert cycle.mirror(str(tmp_path / "a"), str(tmp_path / "b")) == 1
    assert cycle.mirror(str(tmp_path / "none"), str(tmp_path / "b")) == 0


def test_cli(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    book(tmp_path / "b_2020.xlsx", {"Sheet": ROWS})
    project(tmp_path / "p.yaml")
    args = ["import-spec", str(tmp_path / "b_2020.xlsx"), "--config", str(tmp_path / "p.yaml"), "--out", str(tmp_path / "specs")]
    assert cli.main(args) == 0
    assert cli.main(args) == 1  # exists
    assert cli.main([*args, "--force"]) == 0
    assert cli.main(["validate-specs", "--spec-dir", str(tmp_path / "specs")]) == 0
    assert "OK (1 trade type, 1 spec)" in capsys.readouterr().out
    drop(tmp_path / "in", "Sheet_202401N.TXT.zip", [line("202401", n) for n in range(4)])
    assert cli.main(["ingest", "--input", str(tmp_path / "in"), "--output", str(tmp_path / "out"), "--spec-dir", str(tmp_path / "specs"), "--current-year", "2024"]) == 0
    assert "1 ok, 0 failed, 4 rows" in capsys.readouterr().out
    assert cli.main(["inspect", str(tmp_path / "in" / "Sheet_202401N.TXT.zip"), "--spec-dir", str(tmp_path / "specs"), "-n", "1"]) == 0
    assert "--- line 1 (length=24) ---" in capsys.readouterr().out
    assert cli.main(["validate-specs", "--spec-dir", str(tmp_path / "none")]) == 1
    assert cli.main(["version"]) == 0
