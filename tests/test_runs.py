import threading
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.runs import SCHEMAS, RunLedger
from tidemark.plans.ingest import ingest, register_publisher, resolve_publisher
from tidemark.plans.tables import ConflictError
from tidemark.sources.contract import ColumnContract, DatasetContract, typed_rows, with_sentinels
from tidemark.sources.detect import SourceError
from tidemark.functions.normalize import NumberProfile
from tidemark.operators import quality as q

T0 = datetime(2024, 1, 1, tzinfo=UTC)


def rows(spark, table, *dicts):
    schema = spark.createDataFrame([], SCHEMAS[table]).schema
    return spark.createDataFrame([tuple(d.get(f.name) for f in schema) for d in dicts], schema)


@pytest.fixture
def ledger(spark, tmp_path):
    made = RunLedger(spark, f"file://{tmp_path}/ledger", {"gold": "k long"})
    made.commit(lambda t: {
        "runs": rows(spark, "runs", {"run_id": 1, "idempotency_key": "a", "file_id": 1, "batch_id": 1, "status": "PENDING"}, {"run_id": 2, "idempotency_key": "b", "file_id": 2, "batch_id": 1, "status": "STAGED"}),
        "files": rows(spark, "files", {"file_id": 1, "status": "DISCOVERED"}, {"file_id": 2, "status": "DISCOVERED"}),
        "batches": rows(spark, "batches", {"batch_id": 1, "status": "OPEN"}),
    })
    return made


def test_claims_and_leases(ledger):
    assert ledger.claim("a", "w1", now=T0) == 1
    assert ledger.claim("a", "w2", now=T0 + timedelta(minutes=4)) is None  # a live lease
    assert ledger.claim("none", "w2", now=T0) is None and ledger.claim("b", "w2", now=T0) is None
    ledger.heartbeat(1, T0 + timedelta(minutes=9), 10, 8)
    assert ledger.claim("a", "w2", now=T0 + timedelta(minutes=6)) is None
    assert ledger.claim("a", "w2", 2, now=T0 + timedelta(minutes=10)) == 1
    row = ledger.read("runs").filter("run_id = 1").first()
    assert (row.worker, row.try_number, row.rows_read, row.started_at) == ("w2", 2, 10, T0.replace(tzinfo=None))
    ledger.heartbeat(2, T0, 1, 1)
    assert ledger.read("runs").filter("run_id = 2").first().rows_read is None  # doesn't run


def test_of_two_claims_at_once_one_wins(ledger):
    got, failed = [], []

    def work(name):
        try:
            got.append(ledger.claim("a", name, now=T0))
        except ConflictError as e:
            failed.append(e)

    threads = [threading.Thread(target=work, args=(f"w{k}",)) for k in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(got, key=str) == [1, None, None] and not failed


def test_stages_and_finalise(spark, ledger):
    assert ledger.claim_stage(1, "PUBLISH", "w", now=T0) is False  # not staged
    assert ledger.claim_stage(2, "PUBLISH", "w", now=T0) is True and ledger.claim_stage(2, "PUBLISH", "v", now=T0) is False
    assert ledger.claim_stage(2, "PUBLISH", "v", now=T0 + timedelta(minutes=6)) is True
    done = spark.createDataFrame([(2, 2, 1, 7, T0.replace(tzinfo=None), 5, "r")], "run_id long, file_id long, batch_id long, rows_loaded long, finished_at timestamp, duration_ms long, report_uri string")

    def breaks(t):
        raise RuntimeError("no gold")

    with pytest.raises(RuntimeError):
        ledger.finalise(done, breaks)
    assert ledger.read("runs").filter("run_id = 2").first().status == "STAGED" and ledger.read("gold").count() == 0
    ledger.finalise(done, lambda t: {"gold": t["gold"].unionByName(spark.range(3).toDF("k"))})
    assert {r.run_id: r.status for r in ledger.read("runs").collect()} == {1: "PENDING", 2: "SUCCEEDED"}
    assert {r.file_id: r.status for r in ledger.read("files").collect()} == {1: "DISCOVERED", 2: "PROCESSED"}
    assert ledger.read("batches").first().status == "PUBLISHED" and ledger.read("gold").count() == 3


def test_records_of_a_run_replace_themselves(spark, ledger):
    finding = lambda run, failed: rows(spark, "findings", {"run_id": run, "rule_id": "r", "failed_count": failed})
    ledger.record("findings", finding(1, 5), 1)
    ledger.record("findings", finding(2, 6), 2)
    ledger.record("findings", finding(1, 7), 1)
    assert sorted((r.run_id, r.failed_count) for r in ledger.read("findings").collect()) == [(1, 7), (2, 6)]
    gap = spark.createDataFrame([("d", "run-1", None)], SCHEMAS["gaps"])
    ledger.record("gaps", gap)
    ledger.record("gaps", gap)
    assert ledger.read("gaps").count() == 1


def test_contracts_are_checked():
    key = ColumnContract("id", "integer", business_key=True)
    german = ColumnContract("amount", "decimal", numbers=NumberProfile(",", "."))
    DatasetContract("d", (key, german), ";", ("id",))
    for code, make in (
        ("delimiter-is-decimal-separator", lambda: DatasetContract("d", (key, german), ",")),
        ("dedup-key-is-no-business-key", lambda: DatasetContract("d", (key, german), ";", ("amount",))),
        ("several-business-keys", lambda: DatasetContract("d", (key, ColumnContract("x", business_key=True)))),
        ("duplicate-column", lambda: DatasetContract("d", (key, ColumnContract("id")))),
        ("unknown-type", lambda: DatasetContract("d", (ColumnContract("x", "money"),))),
        ("pivot-missing", lambda: DatasetContract("d", (ColumnContract("x", "date", date_format="%d%m%y"),))),
        ("rule-on-unknown-column", lambda: DatasetContract("d", (key,), rules=(q.Rule("completeness", "y"),))),
        ("sentinels of unknown columns", lambda: with_sentinels(DatasetContract("d", (key,)), {"y": ["-"]})),
    ):
        with pytest.raises(SourceError, match=code):
            make()


def test_ingest_and_cast(spark, tmp_path):
    contract = DatasetContract("d", (ColumnContract("id", "integer", nullable=False, business_key=True), ColumnContract("name"), ColumnContract("amount", "decimal", numbers=NumberProfile(",", "."))), ";", rules=(q.Rule("completeness", "name"),))
    contract = with_sentinels(contract, {"name": ["-"]})
    (tmp_path / "a.csv").write_text("id;name;amount\n1;x;1.234,50\n2;y;zz\n3;z\n4;-;5\n99999999999999999999;q;1\n", encoding="utf-8")
    found = ingest(spark, str(tmp_path / "a.csv"), contract)
    assert [(r.id, r.name, r.amount) for r in found.good.orderBy(F.length("id")).collect()] == [("1", "x", "1234.5"), ("99999999999999999999", "q", "1")]
    assert {r.error_type for r in found.rejects.collect()} == {"COMPLETENESS_VIOLATION", "RAGGED_ROW", "invalid-numeric-value"} and found.rejects.count() == 3
    cast = typed_rows(found.good, contract)
    assert [(r.id, str(r.amount)[:6]) for r in cast.good.collect()] == [(1, "1234.5")] and cast.rejects.first().error_type == "not-castable-to-integer"


def test_publishers():
    assert resolve_publisher("upsert").__name__ == "upsert"
    with pytest.raises(ValueError, match="no publisher"):
        resolve_publisher("none")
    with pytest.raises(ValueError, match="there is a publisher"):
        register_publisher("scd", lambda: None)
