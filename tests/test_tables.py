import pytest
from pyspark.sql import functions as F

from tidemark.operators import quality as q
from tidemark.plans.tables import BronzeTable, VersionedTable
from tidemark.streaming.micro_batch import run_available


def test_versions(spark, tmp_path):
    table = VersionedTable(spark, f"file://{tmp_path}/t", "k int, v string")
    assert table.read().count() == 0 and table.current() is None
    first = table.publish(lambda now: now.unionByName(spark.createDataFrame([(1, "a")], "k int, v string")))
    table.publish(lambda now: now.unionByName(spark.createDataFrame([(2, "b")], "k int, v string")))
    assert table.current() != first and sorted(r.k for r in table.read().collect()) == [1, 2]

    def fails(now):
        raise RuntimeError("before the swap")

    with pytest.raises(RuntimeError):
        table.publish(fails)
    assert table.read().count() == 2


def test_publications_never_show_less_and_never_overwrite(spark, tmp_path):
    from tidemark.plans.tables import ConflictError, VersionedTables

    at = f"file://{tmp_path}/t"
    make = lambda: VersionedTables(spark, at, {"a": "k int", "b": "k int"})
    one, two = make(), make()
    row = lambda k: spark.createDataFrame([(k,)], "k int")
    one.publish(lambda t: {"a": row(1), "b": row(1)})

    def slow(t):
        one.publish(lambda now: {"a": now["a"].unionByName(row(2))})
        return {"a": t["a"].unionByName(row(3))}

    with pytest.raises(ConflictError):
        two.publish(slow)
    assert sorted(r.k for r in two.read("a").collect()) == [1, 2] and two.read("b").count() == 1
    commits = tmp_path / "t" / "_commits"
    assert sorted(p.name for p in commits.iterdir() if not p.name.startswith(".")) == [f"{k:012d}" for k in (1, 2)]
    (commits / f"{3:012d}").write_text("")  # another one is being written: its number is taken
    with pytest.raises(ConflictError):
        two.publish(lambda t: {"b": row(9)})
    assert sorted(r.k for r in one.read("a").collect()) == [1, 2]
    import os

    os.utime(commits / f"{3:012d}", (1, 1))  # it died long ago
    assert two.publish(lambda t: {"b": row(9)}) == 4 and one.read("b").first().k == 9 and one.publish(lambda t: {}) == 4


def test_bronze_of_an_empty_rerun_has_no_rows(spark, tmp_path):
    bronze = BronzeTable(spark, f"{tmp_path}/b", "k int")
    assert bronze.read().count() == 0 and bronze.read().columns == ["k", "_run_id"]
    rows = spark.range(3).select(F.col("id").cast("int").alias("k"))
    bronze.append(rows, 1)
    bronze.append(rows, 2)
    bronze.append(rows.filter("k < 0"), 1)
    assert [r["_run_id"] for r in bronze.read().collect()] == [2, 2, 2]
    bronze.append(bronze.read().filter("_run_id = 2 AND k > 0"), 2)  # reads what it replaces
    assert bronze.read().count() == 2
    staged = bronze.stage(rows, 3)
    assert staged.dtypes == [("k", "string")] and staged.count() == 3 and bronze.read().count() == 2


def test_bronze_runs_replace_themselves(spark, tmp_path):
    bronze = BronzeTable(spark, f"{tmp_path}/b", "k int")
    for n in (2, 2, 3):
        bronze.append(spark.range(n).select(F.col("id").cast("int").alias("k")), n)
    assert bronze.read().groupBy("_run_id").count().orderBy("_run_id").collect() == [(2, 2), (3, 3)]


def test_stream_replay(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(r, "k int, ts timestamp, v string")
    from datetime import datetime

    day = lambda d: datetime(2024, 1, d)
    rows((1, day(5), "new"), (2, day(1), "x")).write.mode("append").parquet(f"{tmp_path}/in")
    run = lambda: {r.k: r.v for r in run_available(spark, spark.readStream.schema("k int, ts timestamp, v string").parquet(f"{tmp_path}/in"), f"file://{tmp_path}/out", ["k"], ("ts", "v")).collect()}
    assert run() == {1: "new", 2: "x"} == run()
    rows((1, day(3), "late"), (2, day(9), "newer"), (3, day(1), "y")).write.mode("append").parquet(f"{tmp_path}/in")
    assert run() == {1: "new", 2: "newer", 3: "y"}


def test_breakers_and_dispatch(spark):
    q.breaker(1, 2, 0.5)
    q.breaker(0, 0, 0.0)
    with pytest.raises(q.QualityError):
        q.breaker(2, 3, 0.5)
    df = spark.createDataFrame([(1, "a"), (2, None)], "o int, name string")
    stop = (q.Rule("completeness", "name", "FAIL_FILE"),)
    with pytest.raises(q.QualityError, match="FAIL_FILE"):
        q.dispatch(q.split(df, stop, "o").findings)
    assert q.split(df, (), "o").good.count() == 2
    with pytest.raises(ValueError):
        q.Rule("unknown", "name")
    nan = spark.createDataFrame([("nan",), ("5",), ("50",), ("x",)], "v string").select(q.validity_range(F.col("v"), 1, 10).alias("e")).collect()
    assert [r.e for r in nan] == [None, None, "VALIDITY_RANGE_VIOLATION", "VALIDITY_RANGE_UNPARSEABLE"]
