"""Silver tables brought up to date by key, and what is lost on the way taken up again."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlake.plans import bronze, silver, upsert
from cartlake.sources.batches import read_state
from cartlake.sources.tables import write_table
from cartlake.specs import LOAD_ID, TableSpec


def spec(bad="null", by=("year", "month"), keys=("id",)):
    return TableSpec(
        "orders",
        "orders/*.csv",
        keys,
        timestamp_column="bought",
        partition_by=by,
        types={"id": T.StringType(), "state": T.StringType()},
        bad_timestamps=bad,
    )


FIRST = "id,state,bought\na,new,2020-01-05 00:00:00\nb,new,2020-01-06 00:00:00\nc,new,2020-02-07 00:00:00\nd,new,2020-03-01 00:00:00\na,new,2020-01-05 00:00:00\n,none,2020-01-01 00:00:00\ne,new,?\n"
# a moves to another month, b changes its state, d moves and leaves its month empty, f and g are new,
# the newer row of c cannot be read in one variant, e can be read now.
SECOND = "id,state,bought\na,moved,2020-02-05 00:00:00\nb,paid,2020-01-06 00:00:00\nd,moved,2020-02-01 00:00:00\nf,new,2020-04-01 00:00:00\nf,new,2020-04-01 00:00:00\nc,lost,someday\ne,read,2020-01-09 00:00:00\n,none,2020-05-05 00:00:00\n"
THIRD = "id,state,bought\na,back,2020-01-07 00:00:00\n"


class Shop:
    def __init__(self, spark, layers, folder, table):
        self.args = (spark, layers, folder, table)
        (folder / "orders").mkdir()
        self.n = 0

    def land(self, text):
        spark, layers, folder, table = self.args
        self.n += 1
        (folder / "orders" / f"{self.n}.csv").write_text(text)
        bronze.load(spark, table, str(folder), layers, skip_loaded=True, by_load=True)

    def load(self, mode="incremental"):
        spark, layers, _, table = self.args
        return silver.load(spark, table, layers, mode=mode)

    def silver(self):
        spark, layers, _, table = self.args
        return rows(spark.table(f"{layers.silver}.orders").drop("_updated_at"))

    def rejected(self):
        spark, layers, *_ = self.args
        found = spark.table(f"{layers.dlq}.orders_rejected")
        return rows(found, "id", "state", F.substring("bought", 1, 10), "_dlq_reason")


@pytest.fixture
def shop(spark, layers, tmp_path):
    return lambda table: Shop(spark, layers, tmp_path, table)


@pytest.mark.parametrize("bad, by", [("null", ("year", "month")), ("reject", ("year", "month")), ("null", ())])
def test_equals_a_rebuild(shop, bad, by):
    s = shop(spec(bad, by))
    s.land(FIRST)
    s.load()
    s.land(SECOND)
    done = s.load()
    s.land(THIRD)
    assert s.load() == (1, 1, ()) and s.load() == (0, 0, ())
    mine, letters = s.silver(), s.rejected()
    assert done.rows == (6 if bad == "null" else 5)
    keys = [r[0] for r in mine]
    assert len(keys) == len(set(keys)) and dict.fromkeys(keys).keys() >= set("abdef")
    s.load("overwrite")
    assert s.silver() == mine
    # Keys without a value are told apart from copies load by load.
    plain = [[r[:3] for r in x] for x in (letters, s.rejected())]
    if bad == "null":
        # The older row of e had no time that could be read, so silver had none.
        plain = [[tuple(v for v in r if v != "?") if r[0] == "e" else r for r in x] for x in plain]
        plain = [[r if r[0] != "e" else ("e", "new") for r in x] for x in plain]
    assert sorted(plain[0], key=repr) == sorted(plain[1], key=repr)


def test_emptied_partitions_go(spark, layers, shop):
    s = shop(spec())
    s.land(FIRST)
    s.load()
    s.land(SECOND)
    s.load()
    found = {tuple(r) for r in spark.table(f"{layers.silver}.orders").select("year", "month").distinct().collect()}
    have = {r[0] for r in spark.sql(f"SHOW PARTITIONS {layers.silver}.orders").collect()}
    assert len(have) == len(found) and "year=2020/month=3" not in have


def test_reads_only_new_loads_and_writes_only_touched_partitions(spark, layers, shop, monkeypatch):
    s = shop(spec())
    s.land(FIRST)
    s.load()
    table = f"{layers.silver}.orders"

    def files():
        return {f for f in spark.table(table).inputFiles()}

    before = files()
    s.land("id,state,bought\nb,paid,2020-01-06 00:00:00\nz,new,2020-06-06 00:00:00\n")
    seen = []
    whole = upsert.prepare

    def prepare(spark, spec, layers, valid, rejects, bronze, loads):
        seen.append((bronze.inputFiles(), bronze._jdf.queryExecution().executedPlan().toString()))
        return whole(spark, spec, layers, valid, rejects, bronze, loads)

    monkeypatch.setattr(upsert, "prepare", prepare)
    s.load()
    (_, plan), loads = seen[0], spark.table(f"{layers.bronze}.orders").select(LOAD_ID).distinct().count()
    assert loads == 2 and "PartitionFilters: [isnotnull(_load_id" in plan
    after = files()
    kept = {f for f in before if "month=1" not in f}
    assert kept and kept <= after and not {f for f in before - kept} & after
    assert {f.split("month=")[1][0] for f in after - before} == {"1", "6"}


MONTHS = ("year", "month")


@pytest.mark.parametrize(
    "step, by",
    [
        ("log_batches", MONTHS),
        ("write_dlq", ()),
        ("replace_partitions", MONTHS),
        ("swap_tables", ()),
        ("after silver", MONTHS),
    ],
)
def test_a_lost_run_is_taken_up(spark, layers, shop, monkeypatch, step, by):
    s = shop(spec(by=by))
    s.land(FIRST)
    s.load()
    s.land(SECOND)

    def lost(*args, **kwargs):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        if step == "after silver":
            log, calls = upsert.log_batches, []

            def second(*args):
                calls.append(1)
                return log(*args) if len(calls) == 1 else lost()

            m.setattr(upsert, "log_batches", second)
        else:
            m.setattr(upsert, step, lost)
        with pytest.raises(KeyboardInterrupt):
            s.load()
    s.load()
    assert read_state(spark, layers, ["orders"])["orders"].prepared is None
    mine, letters = s.silver(), s.rejected()
    s.load("overwrite")
    assert s.silver() == mine and len(s.rejected()) == len(letters)


def test_a_lost_swap(spark, layers, shop):
    """The old table is renamed, the new one not yet in its place."""
    s = shop(spec(by=()))
    s.land(FIRST)
    s.load()
    s.land(SECOND)
    name, apply = f"{layers.silver}.orders", upsert.apply
    upsert.apply = lambda *a: (0, 0)
    try:
        s.load()
    finally:
        upsert.apply = apply
    batch = read_state(spark, layers, ["orders"])["orders"].prepared.batch
    spark.sql(f"ALTER TABLE {name} RENAME TO {name}__{batch}__old")
    s.load()
    mine = s.silver()
    s.load("overwrite")
    assert s.silver() == mine
    assert spark.sql(f"SHOW TABLES IN {layers.silver}").count() == 1


def test_partition_mode_keeps_one_row_per_key(spark, layers):
    table = TableSpec("orders", "", ("id",), "bought", ("year", "month"))

    def load(data):
        write_table(spark.createDataFrame(data, "id int, bought string"), f"{layers.bronze}.orders")
        return silver.load(spark, table, layers, mode="partitions")

    load([(1, "1996-01-05"), (2, "1996-01-06"), (3, "1996-03-01")])
    # Order 1 moves to February, order 3 too, and January is absent.
    assert load([(1, "1996-02-05"), (3, "1996-02-06")]).rows == 2
    assert rows(spark.table(f"{layers.silver}.orders"), "id", "year", "month") == [(1, 1996, 2), (2, 1996, 1), (3, 1996, 2)]


def test_partition_mode_with_maps_and_copies(spark, layers):
    table = TableSpec("orders", "", ("id",), "bought", ("year",), bad_timestamps="reject")
    kind = "id int, bought string, tags map<string,int>"

    def load(data):
        write_table(spark.createDataFrame(data, kind), f"{layers.bronze}.orders")
        return silver.load(spark, table, layers, mode="partitions")

    lost = (None, "1996-01-01", {"a": 1})
    load([(1, "1996-01-05", {"a": 1}), lost, lost, lost, (2, "?", None)])
    # 1997 comes, and one copy of the three again; the others stay.
    load([(3, "1997-01-05", {"b": 1}), lost])
    found = spark.table(f"{layers.dlq}.orders_rejected").groupBy("id", "bought").count()
    assert rows(found) == [(2, "?", 1), (None, "1996-01-01", 3)]
    assert spark.table(f"{layers.silver}.orders").count() == 2


def test_stages_of_a_batch_are_packed(spark, tmp_path):
    staged = upsert._stage(spark.range(10).toDF("id"), str(tmp_path / "stage"))
    assert staged.count() == 10
    assert all(f.endswith(".zstd.parquet") for f in staged.inputFiles())
