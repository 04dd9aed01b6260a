from dataclasses import replace

import pytest

from fwloom import layouts as L
from fwloom.layouts import Computed, Field, Layout, LayoutError, Source

BASE = Layout("imports", "2020-01", "2020-01", 30, (Field("period", 1, 6, "Date", False, "yyyymm_to_date"), Field("code", 7, 10, "Utf8", False), Field("day", 17, 2, "Int64"), Field("value", 19, 9, "Float64")))


def test_valid_and_round_trip(tmp_path):
    full = replace(BASE, effective_to="2023-12", source=Source("a.xlsx", "0", "S", "t", "A", r"^S_(?P<year>\d{4})(?P<month>\d{2})$"), computed_columns=(Computed("when", "Date", "concat_to_date", ("period", "day")), Computed("text", "Utf8", "concat_text", ("code",), separator="-")), dropped_columns=("day",), derived=(("year", "year(period)"),))
    L.save(full, tmp_path / "imports" / "v2020-01.yaml")
    assert L.load_all(tmp_path, "imports") == [full]
    assert L.load_all(tmp_path, "exports_us") == []


@pytest.mark.parametrize(
    "bad",
    [
        {"trade_type": "other"}, {"effective_from": "2020-13"}, {"effective_to": "2019-12"}, {"columns": ()}, {"record_length": 20},
        {"columns": (*BASE.columns, Field("x", 27, 2, "Utf8"))}, {"columns": (*BASE.columns, Field("code", 28, 2, "Utf8"))},
        {"columns": (*BASE.columns, Field("x", 28, 2, "Decimal"))}, {"columns": (*BASE.columns, Field("x", 28, 0, "Utf8"))},
        {"routing_column": "code"}, {"routing_column": "none"}, {"dropped_columns": ("none",)}, {"dropped_columns": ("period",)},
        {"columns": (*BASE.columns, Field("x", 28, 2, "Int64", False, coerce_invalid_to_null=True))},
        {"computed_columns": (Computed("c", "Date", "concat_to_date", ("period",)),)}, {"computed_columns": (Computed("code", "Utf8", "concat_text", ("code",)),)},
        {"computed_columns": (Computed("c", "Utf8", "concat_text", ("value",)),)}, {"source": Source("a", "0", "S", "t", None, "^S$")},
        {"source": Source("a", "0", "S", "t", None, r"^(?P<year>\d)(?P<month>\d)(?P<x>\d)$")},
    ],
)
def test_rejects(bad):
    with pytest.raises(LayoutError):
        L.check(replace(BASE, **bad))


def test_resolve_and_periods():
    versions = [replace(BASE, version=v, effective_from=v, effective_to=to) for v, to in (("2020-01", "2020-12"), ("2021-01", None), ("2022-01", None))]
    assert L.resolve(versions, "2020-12").version == "2020-01"
    assert L.resolve(versions, "2022-05").version == "2022-01"
    with pytest.raises(LayoutError):
        L.resolve(versions, "2019-12")
    assert L.next_period("2020-12") == "2021-01"
