import pytest
from pyspark.sql import types as T

from cartlake.specs import (
    RETAIL_LINE_COUNTS,
    RETAIL_TABLES,
    QualityThresholds,
    TableSpec,
    expected_lines,
    load_specs,
    load_thresholds,
    retail_specs,
)


def test_from_mapping():
    entry = {
        "name": "o",
        "source_file": "o.csv",
        "key_columns": ["id"],
        "timestamp_column": "at",
        "partition_by": ["year", "month"],
        "description": "orders",
    }
    assert TableSpec.from_mapping(entry) == TableSpec(
        "o", "o.csv", ("id",), "at", ("year", "month"), description="orders"
    )
    assert TableSpec.from_mapping({"name": "x", "source_file": "x.csv"}).keys == ()


@pytest.mark.parametrize(
    "wrong",
    [
        {"partition_by": ("year",)},
        {"partition_by": ("day",), "timestamp_column": "at"},
        {"bad_timestamps": "drop"},
    ],
)
def test_wrong_specs(wrong):
    with pytest.raises(ValueError):
        TableSpec("t", "t.csv", **wrong)


def test_retail_tables():
    assert len(RETAIL_TABLES) == 9
    assert {t.name for t in RETAIL_TABLES} == set(RETAIL_LINE_COUNTS)
    assert all(set(t.keys) <= set(t.types) for t in RETAIL_TABLES)
    assert [t.name for t in RETAIL_TABLES if t.partition_by] == ["orders"]
    assert retail_specs({"orders": "o/*.csv"}, multi_line=False)[1].source == "o/*.csv"


def test_config_files(tmp_path):
    tables = tmp_path / "tables.json"
    tables.write_text('{"tables": [{"name": "a", "source_file": "a.csv", "key_columns": ["k"]}]}')
    assert load_specs(str(tables)) == (TableSpec("a", "a.csv", ("k",)),)
    limits = tmp_path / "limits.json"
    limits.write_text('{"quality": {"max_null_ratio": 0.5, "fail_on_quality_error": true}}')
    assert load_thresholds(str(limits)) == QualityThresholds(0.5, 0.01, True)
    yaml = pytest.importorskip("yaml")
    (tmp_path / "t.yaml").write_text(yaml.safe_dump({"tables": [{"name": "a", "source_file": "a.csv"}]}))
    assert load_specs(str(tmp_path / "t.yaml"))[0].name == "a"


def test_specs_with_types(tmp_path):
    entry = {
        "name": "a",
        "source_file": "a.csv",
        "types": {"id": "bigint", "price": "decimal(18, 2)", "at": "timestamp"},
        "bad_timestamps": "reject",
        "null_keys_first": True,
        "expected_lines": 7,
    }
    spec = TableSpec.from_mapping(entry)
    assert spec.types == {"id": T.LongType(), "price": T.DecimalType(18, 2), "at": T.TimestampType()}
    assert (spec.bad_timestamps, spec.null_keys_first) == ("reject", True)
    assert expected_lines([spec, TableSpec("b", "b.csv"), RETAIL_TABLES[0]]) == {"a.csv": 7, "customers.csv": 99442}
    with pytest.raises(ValueError, match="unknown keys key_cols"):
        TableSpec.from_mapping({"name": "a", "source_file": "a.csv", "key_cols": ["k"]})
    with pytest.raises(ValueError, match="unknown type"):
        TableSpec.from_mapping({**entry, "types": {"id": "number"}})
