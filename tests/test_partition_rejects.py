"""Dead letters of a silver load that replaces partitions."""

import pytest
from conftest import rows
from pyspark.sql import types as T

from cartlake.plans import silver
from cartlake.sources.tables import write_table
from cartlake.specs import TableSpec


@pytest.mark.parametrize("bad", ["null", "reject"])
def test_rejects_of_kept_partitions_stay(spark, layers, bad):
    spec = TableSpec(
        "orders",
        "orders.csv",
        ("id",),
        timestamp_column="bought",
        partition_by=("year",),
        types={"id": T.StringType()},
        bad_timestamps=bad,
    )

    def load(data, mode):
        write_table(spark.createDataFrame(data, "id string, bought string"), f"{layers.bronze}.orders")
        return silver.load(spark, spec, layers, mode=mode)

    def rejected():
        return rows(spark.table(f"{layers.dlq}.orders_rejected"), "id", "bought", "_dlq_reason")

    old, new = "1996-05-01 00:00:00", "1997-05-01 00:00:00"
    load([("a", old), ("a", old), (None, old), ("b", new), ("b", new), ("c", new), ("d", "no date")], "overwrite")
    before = rejected()
    stamps = rows(spark.table(f"{layers.dlq}.orders_rejected").where(f"bought = '{old}'"))
    assert len(before) == (4 if bad == "reject" else 3)

    # Bronze now holds 1997 only, twice in a row.
    for _ in range(2):
        done = load([("b", new), ("c", new), ("c", new), (None, new), ("e", "never")], "partitions")
        assert done.rejected == (3 if bad == "reject" else 2)
        want = [("a", old, "duplicate_key"), (None, old, "null_key"), ("c", new, "duplicate_key"), (None, new, "null_key")]
        if bad == "reject":
            want += [("d", "no date", "bad_timestamp"), ("e", "never", "bad_timestamp")]
        assert [r[:2] for r in rejected()] == [r[:2] for r in sorted(want, key=repr)]
        assert rows(spark.table(f"{layers.dlq}.orders_rejected").where(f"bought = '{old}'")) == stamps

    # Without rejects in 1997 its earlier ones go, those of 1996 stay.
    load([("b", new)], "partitions")
    assert {r[1] for r in rejected()} == ({old, "no date", "never"} if bad == "reject" else {old})
