import pytest
from conftest import rows

from cartlake.operators.duplicates import profile_keys
from cartlake.operators.quality import (
    QualityError,
    duplicate_ratio,
    enforce_gate,
    null_ratios,
    quality_gate,
)
from cartlake.specs import QualityThresholds


@pytest.fixture
def df(spark):
    return spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (3, "c")], "k int, v string")


def test_null_ratios(df):
    assert rows(null_ratios(df)) == [("k", 0, 4, 0.0), ("v", 1, 4, 0.25)]
    assert rows(null_ratios(df, ["v"])) == [("v", 1, 4, 0.25)]
    assert rows(null_ratios(df.where("false"))) == [("k", 0, 0, 0.0), ("v", 0, 0, 0.0)]


def test_duplicate_ratio(df):
    assert rows(duplicate_ratio(df, ["k"])) == [(4, 1, 0.25)]
    assert rows(duplicate_ratio(df, ["k", "v"])) == [(4, 0, 0.0)]
    assert rows(duplicate_ratio(df.where("false"), ["k"])) == [(0, 0, 0.0)]


def test_gate(df):
    limits = QualityThresholds(max_null_ratio=0.3, max_duplicate_ratio=0.1)
    expected = [
        ("duplicate_ratio", "k", 0.25, 0.1, False),
        ("null_ratio", "k", 0.0, 0.3, True),
        ("null_ratio", "v", 0.25, 0.3, True),
    ]
    assert rows(quality_gate(df, ["k"], limits)) == expected
    assert rows(quality_gate(df, ["k"], limits, profile_keys(df, ["k"]))) == expected
    assert len(rows(quality_gate(df, [], limits))) == 2


def test_gate_raises_only_if_asked(df):
    report = quality_gate(df, ["k"])
    assert len(enforce_gate(report, QualityThresholds())) == 2
    with pytest.raises(QualityError, match="duplicate_ratio of k is 0.2500, limit 0.01"):
        enforce_gate(report, QualityThresholds(fail_on_quality_error=True))
    loose = QualityThresholds(1.0, 1.0, True)
    assert enforce_gate(quality_gate(df, ["k"], loose), loose) == []
