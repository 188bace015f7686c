"""Whole runs over growing raw files, and what they read and write of the star."""

import pytest
from conftest import rows
from test_layers import RAW

from cartlake.plans import gold, medallion
from cartlake.sources.batches import read_state
from cartlake.specs import retail_specs

SPECS = retail_specs({n: f"{n}/*.csv" for n in RAW})

# A late payment and a late review of an order of October 2017, an order that moves from January to
# February 2018, a changed price in January, a new customer with the first order of March.
LATER = {
    "order_payments": ["o1,3,voucher,1,1.00"],
    "order_reviews": ["r9,o1,1,,2018-05-05 00:00:00"],
    "orders": [
        "o2,c2,shipped,2018-02-06 10:00:00,,2018-03-01 00:00:00,2018-02-01 00:00:00",
        "o4,c4,created,2018-03-01 00:00:00,,,2018-04-01 00:00:00",
    ],
    "customers": ["c4,u4,20000,rio,RJ"],
}


def land(folder, name, lines, n):
    (folder / name).mkdir(exist_ok=True)
    header = RAW[name].split("\n", 1)[0]
    text = RAW[name] if lines is None else "\n".join([header, *lines]) + "\n"
    (folder / name / f"{n}.csv").write_text(text, encoding="utf-8")


def run(spark, folder, layers):
    return medallion.run(spark, str(folder), SPECS, layers, mode="incremental")


def star(spark, layers):
    tables = gold.read_star(spark, layers)._asdict()
    return {n: rows(df.drop("_updated_at", "_ingested_at")) for n, df in tables.items()}


def files(spark, layers, name):
    return set(spark.table(f"{layers.gold}.{name}").inputFiles())


def months(paths):
    return {p.split("year=")[1].split("/part")[0].replace("/month=", "-") for p in paths}


@pytest.fixture
def first(spark, layers, tmp_path):
    for name in RAW:
        land(tmp_path, name, None, 1)
    run(spark, tmp_path, layers)
    return tmp_path


def test_equals_a_rebuild_and_writes_touched_partitions_only(spark, layers, first):
    before = {n: files(spark, layers, n) for n in gold.Star._fields}
    for name, lines in LATER.items():
        land(first, name, lines, 2)
    done = run(spark, first, layers)
    assert set(done) == {"dim_customers", "dim_dates", "fact_order_payments", "fact_order_sales"}
    after = {n: files(spark, layers, n) for n in gold.Star._fields}
    for name in ("dim_sellers", "dim_products", "dim_geolocation"):
        assert after[name] == before[name]
    # o3 of January 2018 has items and no payments; nobody paid for o4, and it has no items.
    assert months(after["fact_order_payments"] - before["fact_order_payments"]) == {"2017-10", "2018-2"}
    assert months(after["fact_order_payments"]) == {"2017-10", "2018-2"}
    assert months(after["fact_order_sales"] - before["fact_order_sales"]) == {"2017-10", "2018-1", "2018-2"}
    mine = star(spark, layers)
    scores = {r.order_id: r.avg_review_score for r in spark.table(f"{layers.gold}.fact_order_sales").collect()}
    assert scores["o1"] == pytest.approx(8 / 3)
    for state in read_state(spark, layers, gold.SILVER_INPUTS).values():
        assert not state.pending and state.prepared is None
    medallion.run_silver(spark, SPECS, layers)
    medallion.run_gold(spark, layers)
    assert star(spark, layers) == mine


def test_an_untouched_month_is_not_written_and_nothing_new_does_nothing(spark, layers, first):
    before = files(spark, layers, "fact_order_sales")
    land(first, "order_reviews", ["r8,o3,5,,2018-05-05 00:00:00"], 2)
    assert set(run(spark, first, layers)) == {"fact_order_sales"}
    after = files(spark, layers, "fact_order_sales")
    assert months(after - before) == {"2018-1"} and months(after & before) == {"2017-10"}
    assert run(spark, first, layers) == {} and files(spark, layers, "fact_order_sales") == after


def test_a_lost_gold_build_is_taken_up(spark, layers, first, monkeypatch):
    for name, lines in LATER.items():
        land(first, name, lines, 2)

    def lost(*args):
        raise OSError("no more disk")

    with monkeypatch.context() as m:
        m.setattr(gold, "replace_partitions", lost)
        with pytest.raises(gold.GoldFailed):
            run(spark, first, layers)
    assert any(s.pending for s in read_state(spark, layers, gold.SILVER_INPUTS).values())
    # No new files this time; the batches wait.
    run(spark, first, layers)
    mine = star(spark, layers)
    medallion.run_silver(spark, SPECS, layers)
    medallion.run_gold(spark, layers)
    assert star(spark, layers) == mine


def test_items_are_not_picked_first_where_all_months_change(spark, layers, first, monkeypatch):
    """The fact's own join leaves out items without an order; picking them before is one more shuffle."""
    seen = []
    real = gold.key_load

    def watched(df, on):
        seen.append(df._jdf.queryExecution().analyzed().toString())
        return real(df, on)

    monkeypatch.setattr(gold, "key_load", watched)
    ids = [line.split(",")[0] for line in RAW["orders"].strip().split("\n")[1:]]
    land(first, "order_payments", [f"{i},9,voucher,1,1.00" for i in sorted({*ids, "nowhere"})], 2)
    run(spark, first, layers)
    assert len(seen) == 1 and "LeftSemi" not in seen[0]
    before = star(spark, layers)
    assert "nowhere" not in {r.order_id for r in gold.read_star(spark, layers).fact_order_payments.collect()}
    medallion.run_gold(spark, layers)
    assert star(spark, layers) == before
