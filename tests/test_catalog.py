"""Published tables by name, their retention, and inputs from the catalog."""

import datetime as dt
import os
import re

import pytest

from recurra.plans.pipeline import Pipeline
from recurra.sources import catalog
from recurra.sources.catalog import TableStore, run_started
from recurra.sources.sinks import current_run, expire_runs
from recurra.sources.tables import COLUMNS, InputError, conform, read_catalog, read_inputs
from tests.test_publish import CONFIG, store

HOUR = dt.timedelta(hours=1)


@pytest.fixture()
def database(spark, tmp_path):
    name = f"pub_{re.sub(r'\W', '_', tmp_path.name)}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/{name}.db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def numbers(spark, n, product="All"):
    return spark.range(n).selectExpr("id", f"'{product}' AS for_product", "id * 2 AS `odd name`")


def failing(spark):
    return spark.range(1).selectExpr("raise_error('broken output') AS id", "'x' AS for_product")


def later(monkeypatch, hours):
    """Runs from now on begin that much later."""
    real = catalog.time.time
    monkeypatch.setattr(catalog.time, "time", lambda: real() + hours * 3600)


def test_readers_use_a_name(spark, database):
    tables = TableStore(spark, database)
    first = tables.publish({"a": numbers(spark, 3), "b": numbers(spark, 1)})
    reader = f"SELECT count(*) AS n FROM {database}.a"
    assert spark.sql(reader).first().n == 3
    assert spark.table(f"{database}.a").columns == ["id", "for_product", "odd name"]  # as published
    second = tables.publish({"a": numbers(spark, 5), "b": numbers(spark, 2)})
    assert spark.sql(reader).first().n == 5
    assert tables.published() == {"a": second, "b": second} and tables.runs() == sorted([first, second])
    assert abs(run_started(second) - dt.datetime.now(dt.timezone.utc)) < HOUR


def test_partitions_are_pruned_through_the_view(spark, database):
    both = numbers(spark, 3).unionByName(numbers(spark, 4, "Kettle"))
    TableStore(spark, database).publish({"a": both})
    df = spark.table(f"{database}.a").filter("for_product = 'Kettle'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(for_product" in plan and df.count() == 4


def test_a_run_that_fails_to_write_changes_nothing(spark, database):
    tables = TableStore(spark, database)
    first = tables.publish({"a": numbers(spark, 3), "b": numbers(spark, 1)})
    with pytest.raises(Exception, match="broken output"):
        tables.publish({"a": numbers(spark, 9), "b": failing(spark)})
    assert tables.published() == {"a": first, "b": first} and tables.runs() == [first]
    assert spark.table(f"{database}.a").count() == 3


def test_a_run_that_fails_to_switch_is_taken_back(spark, database):
    tables = TableStore(spark, database)
    first = tables.publish({"a": numbers(spark, 3)})
    spark.sql(f"CREATE TABLE {database}.taken (id bigint) USING parquet")  # somebody's table, not ours to replace
    with pytest.raises(Exception, match="taken"):
        tables.publish({"a": numbers(spark, 9), "fresh": numbers(spark, 1), "taken": numbers(spark, 1)})
    assert tables.published() == {"a": first} and tables.runs() == [first]
    assert spark.table(f"{database}.a").count() == 3 and spark.table(f"{database}.taken").count() == 0
    assert not spark.catalog.tableExists(f"{database}.fresh")


def test_snapshot_is_of_one_run(spark, database):
    tables = TableStore(spark, database)
    first = tables.publish({"a": numbers(spark, 3), "b": numbers(spark, 1)})
    tables.publish({"a": numbers(spark, 5), "b": numbers(spark, 2)})
    tables._point("a", first, ["id"])  # as seen half way through a switch
    assert {t: df.count() for t, df in tables.snapshot(["a", "b"]).items()} == {"a": 3, "b": 1}
    with pytest.raises(ValueError, match="not published"):
        tables.snapshot(["c"])


def test_expire_drops_what_is_old_and_unnamed(spark, database, monkeypatch):
    tables = TableStore(spark, database)
    runs = [tables.publish({"a": numbers(spark, 1)})]
    later(monkeypatch, 1)
    runs.append(tables.publish({"a": numbers(spark, 2), "b": numbers(spark, 2)}))
    later(monkeypatch, 1)
    lost = catalog.new_run()  # a driver that died while it wrote
    numbers(spark, 7).write.saveAsTable(f"{database}.a__{lost}")
    later(monkeypatch, 1)
    runs.append(tables.publish({"a": numbers(spark, 3)}))  # b still names the second run
    spark.sql(f"CREATE TABLE {database}.other__report (id bigint) USING parquet")
    now = run_started(runs[-1])
    assert tables.expire(10 * HOUR, now=now) == []
    assert tables.expire(HOUR * 1.5, now=now) == [runs[0]]
    assert tables.expire(HOUR / 2, keep=2, now=now) == []
    assert tables.expire(HOUR / 2, now=now) == [lost]
    assert tables.runs() == runs[1:] and spark.table(f"{database}.a").count() == 3 and spark.table(f"{database}.b").count() == 2
    assert spark.catalog.tableExists(f"{database}.other__report")
    assert TableStore(spark, "no_such_database").expire(HOUR) == []


def test_pipeline_publishes_by_name(spark, tmp_path, database):
    store(spark, f"{tmp_path}/in", True)
    given = read_inputs(spark, f"{tmp_path}/in")
    run = Pipeline(given, CONFIG).publish_tables(database)
    months = spark.table(f"{database}.arr_final").filter("for_product = 'All'").collect()
    assert sorted(str(r.pivot_month) for r in months) == ["2000-01-31", "2000-02-29", "2000-03-31", "2000-04-30"]
    assert set(TableStore(spark, database).published().values()) == {run}
    assert {"arr_rollforward", "legacy_tracker", "batch_arr_final"} <= set(TableStore(spark, database).published())


# --- folders -----------------------------------------------------------------


def test_failed_folder_run_leaves_nothing(spark, tmp_path, monkeypatch):
    store(spark, f"{tmp_path}/in", False)
    out = f"{tmp_path}/out"
    run = Pipeline(read_inputs(spark, f"{tmp_path}/in"), CONFIG).publish(out)
    broken = Pipeline(read_inputs(spark, f"{tmp_path}/in"), CONFIG)
    monkeypatch.setattr(Pipeline, "outputs", lambda self: {"a": numbers(spark, 3), "b": failing(spark)})
    with pytest.raises(Exception, match="broken output"):
        broken.publish(out)
    assert current_run(spark, out) == run
    assert sorted(os.listdir(out)) == sorted(n for n in (".current.crc", "current", os.path.basename(run)) if os.path.exists(f"{out}/{n}"))


def test_expire_folders(spark, tmp_path, monkeypatch):
    out = f"{tmp_path}/out"
    monkeypatch.setattr(Pipeline, "outputs", lambda self: {"a": numbers(spark, 3)})
    store(spark, f"{tmp_path}/in", False)
    given = read_inputs(spark, f"{tmp_path}/in")
    runs = [os.path.basename(Pipeline(given, CONFIG).publish(out)) for _ in range(3)]
    lost = "run-lost"  # a driver that died while it wrote, and one that died while it switched
    os.makedirs(f"{out}/{lost}/a")
    with open(f"{out}/.current-run-lost", "w") as f:
        f.write(lost)
    for k, name in enumerate([*runs, lost]):
        os.utime(f"{out}/{name}", (1_000_000 + k, 1_000_000 + k))
    os.utime(f"{out}/.current-run-lost", (1_000_000, 1_000_000))
    assert expire_runs(spark, out, 10**6 * HOUR) == []
    assert expire_runs(spark, out, HOUR, keep=2) == sorted(runs[:2])
    assert not os.path.exists(f"{out}/.current-run-lost")
    assert expire_runs(spark, out, HOUR, keep=0) == [lost]
    assert current_run(spark, out).endswith(runs[2]) and os.path.isdir(f"{out}/{runs[2]}")
    assert expire_runs(spark, f"{tmp_path}/nowhere", HOUR) == []


# --- inputs ------------------------------------------------------------------


def as_tables(spark, base, database, names=()):
    for n in os.listdir(base):
        spark.read.parquet(f"{base}/{n}").write.saveAsTable(f"{database}.{dict(names).get(n, n)}")


@pytest.mark.parametrize("batch", [False, True])
def test_inputs_from_the_catalog(spark, tmp_path, database, batch):
    base = f"{tmp_path}/in"
    store(spark, base, batch)
    as_tables(spark, base, database, {"company_raw": "companies"})
    spark.sql(f"CREATE VIEW {database}.firms AS SELECT *, 1 AS more FROM {database}.companies")
    got = read_catalog(spark, database, {"company_raw": f"{database}.firms"})
    want = read_inputs(spark, base)
    for name, df in vars(want).items():
        other = getattr(got, name)
        assert (df is None) == (other is None)
        if df is not None:
            assert df.dtypes == other.dtypes and sorted(map(str, df.collect())) == sorted(map(str, other.collect()))
    assert (got.classified is not None) is batch


def test_missing_tables_are_named(spark, tmp_path, database):
    store(spark, f"{tmp_path}/in", False)
    as_tables(spark, f"{tmp_path}/in", database)
    spark.sql(f"DROP TABLE {database}.calendar")
    spark.sql(f"DROP TABLE {database}.price_grid")
    with pytest.raises(InputError, match=r"price_grid \(.*price_grid\), calendar"):
        read_catalog(spark, database)
    with pytest.raises(InputError, match="no such input: transactions"):
        read_catalog(spark, database, {"transactions": "x"})


def test_missing_and_mistyped_columns_are_all_named(spark, tmp_path, database):
    store(spark, f"{tmp_path}/in", False)
    as_tables(spark, f"{tmp_path}/in", database)
    wrong = spark.table(f"{database}.transactions_raw").drop("objectid").withColumnRenamed("type", "kind").selectExpr("* except (originalamount)", "'1' AS originalamount")
    wrong.write.saveAsTable(f"{database}.t2")
    spark.sql(f"CREATE VIEW {database}.c2 AS SELECT array(ds) AS ds FROM {database}.calendar")
    with pytest.raises(InputError) as e:
        read_catalog(spark, database, {"transactions_raw": f"{database}.t2", "calendar": f"{database}.c2"})
    told = str(e.value)
    assert "transactions_raw: column originalamount is string, not a number; no column objectid; no column type" in told
    assert "calendar: column ds is array<date>, not a day" in told


def test_columns_take_their_types(spark):
    df = spark.sql("SELECT 7 AS ID, 1.50 AS TransactionArr, date'2000-01-31' AS `date`, * FROM VALUES ('c', 'm', 'n', 'o', 't', 'r') AS v(currentbillingentityid, termlength, customername, objecttypeid, type, matchingrefund)")
    got = conform(df, "classified_transactions")
    assert got.columns == list(COLUMNS["classified_transactions"])
    row = got.first()
    assert (row.id, row.DATE, row.transactionarr) == ("7", dt.datetime(2000, 1, 31), 1.5)
    with pytest.raises(InputError, match="column type stands 2 times"):
        conform(df.withColumnsRenamed({"termlength": "Type"}), "classified_transactions")
