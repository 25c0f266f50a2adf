"""The registered queries of the engine's own operators, with the SQL that must give the same rows.

The test tables are clean, so messy input is made from them by rules that both engines follow. Every query runs over its
whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import normalize as n
from .operators import history as h
from .operators import quality as q
from .operators import reconcile as r
from .operators import runs as m
from .operators.counters import Counters
from .plans.tables import BronzeTable, VersionedTable
from .session import shared_dir
from .sources import contract as c
from .sources import detect, discover
from .sources.scan import CsvOptions, as_columns, concatenated, resume, scan

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
MONEY = "decimal(18,2)"


def query(sql: str | None = None):
    """Registers a function under its own name, with the SQL for the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Bronze rows made from orders: a run per year, a file per month.


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    run = (F.year("o_orderdate") - 1994).cast("int")
    return orders.select(
        "o_custkey",
        "o_orderstatus",
        F.col("o_orderdate").alias("event_ts"),
        F.col("o_orderkey").alias("_source_row_number"),
        run.alias("_run_id"),
        run.alias("_batch_id"),
        F.month("o_orderdate").cast("int").alias("_file_id"),
        n.record_hash(F.col("o_custkey"), F.col("o_orderstatus")).alias("_record_hash"),
    )


def newest() -> list[Column]:
    return h.newest_first("event_ts", "_source_row_number", "_file_id")


BRONZE = """bronze AS (
  SELECT o_custkey, o_orderstatus, o_orderdate AS event_ts, o_orderkey AS _source_row_number, CAST(year(o_orderdate) - 1994 AS INT) AS _run_id,
    CAST(year(o_orderdate) - 1994 AS INT) AS _batch_id, CAST(month(o_orderdate) AS INT) AS _file_id,
    sha256(concat_ws('|', CAST(o_custkey AS VARCHAR), o_orderstatus)) AS _record_hash FROM orders
)"""
NEWEST_SQL = "event_ts DESC NULLS LAST, _source_row_number DESC, _file_id DESC"
WINNERS = f"winners AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {NEWEST_SQL}) AS rn FROM bronze) WHERE rn = 1)"


@query("""
SELECT o_custkey, o_orderkey, o_orderdate, o_orderstatus FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) AS rn FROM orders
) WHERE rn = 1
""")
def dedup_latest_order_per_customer(spark, sf_dir):
    won = h.winners(table(spark, sf_dir, "orders"), ["o_custkey"], h.newest_first("o_orderdate", "o_orderkey"))
    return won.select("o_custkey", "o_orderkey", "o_orderdate", "o_orderstatus")


@query("""
SELECT l_orderkey, l_linenumber, max(l_shipdate) AS l_shipdate, arg_max(l_partkey, (l_shipdate, l_partkey, l_suppkey)) AS l_partkey
FROM lineitem GROUP BY l_orderkey, l_linenumber
""")
def dedup_argmax_distinct_on(spark, sf_dir):
    best = F.max(F.struct("l_shipdate", "l_partkey", "l_suppkey")).alias("w")
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(best).select("l_orderkey", "l_linenumber", "w.l_shipdate", "w.l_partkey")


@query("SELECT sha256(concat_ws('|', text, lang)) AS record_hash, min(doc_id) AS first_doc_id, count(*) AS copies FROM documents GROUP BY 1 HAVING count(*) > 1")
def dedup_exact_row_hash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", n.record_hash(F.col("text"), F.col("lang")).alias("record_hash"))
    return docs.groupBy("record_hash").agg(F.min("doc_id").alias("first_doc_id"), F.count("*").alias("copies")).filter("copies > 1")


def _decided(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_orders(spark, sf_dir)
    return h.decisions(bronze, h.winners(bronze, ["o_custkey"], newest()), "o_custkey")


DECIDED = f"""WITH {BRONZE}, {WINNERS}, decided AS (
  SELECT b.*, w._file_id AS winner_file_id, w._source_row_number AS winner_source_row_number,
    CASE WHEN b._file_id = w._file_id AND b._source_row_number = w._source_row_number THEN 'KEPT'
      WHEN b._batch_id = w._batch_id AND b._record_hash = w._record_hash THEN 'EXACT_DUP_IN_FILE'
      WHEN b._record_hash = w._record_hash THEN 'EXACT_DUP_CROSS_BATCH' ELSE 'SUPERSEDED_BY_NEWER' END AS reason
  FROM bronze b JOIN winners w USING (o_custkey)
)"""


@query(DECIDED + " SELECT _record_hash, json_object('o_custkey', o_custkey)::VARCHAR AS business_key, winner_file_id, winner_source_row_number, _file_id, _source_row_number, reason FROM decided WHERE reason <> 'KEPT'")
def dedup_decision_log(spark, sf_dir):
    key = F.to_json(F.struct("o_custkey")).alias("business_key")
    return _decided(spark, sf_dir).filter("reason != 'KEPT'").select("_record_hash", key, "winner_file_id", "winner_source_row_number", "_file_id", "_source_row_number", "reason")


@query(DECIDED + " SELECT min(_run_id) AS min_run_id, max(_run_id) AS max_run_id, count(*) AS records_received, count(*) FILTER (WHERE reason = 'KEPT') AS records_accepted, 0::BIGINT AS records_rejected, count(*) FILTER (WHERE reason <> 'KEPT') AS records_deduplicated FROM decided")
def dedup_audit_summary(spark, sf_dir):
    return h.audit(_decided(spark, sf_dir))


@query(f"WITH {BRONZE}, {WINNERS} SELECT o_custkey, o_orderstatus, event_ts, _source_row_number, _run_id FROM winners")
def incremental_silver_merge(spark, sf_dir):
    bronze = bronze_orders(spark, sf_dir)
    silver = h.winners(bronze.filter("_run_id <= 4"), ["o_custkey"], newest())
    return h.merge_incremental(silver, bronze, ["o_custkey"], newest(), 4).select("o_custkey", "o_orderstatus", "event_ts", "_source_row_number", "_run_id")


LATE = "late AS (SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 50 = 0 THEN 2 ELSE 1 END AS _run_id FROM events)"


@query(f"WITH {LATE} SELECT user_id, event_id, ts, event_type, _run_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS rn FROM late) WHERE rn = 1")
def late_arrival_resolution(spark, sf_dir):
    late = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", F.when(F.col("event_id") % 50 == 0, 2).otherwise(1).alias("_run_id"))
    order = h.newest_first("ts", "event_id")
    silver = h.winners(late.filter("_run_id = 1"), ["user_id"], order)
    return h.merge_incremental(silver, late, ["user_id"], order, 1).select("user_id", "event_id", "ts", "event_type", "_run_id")


EVENT_SCD = h.Scd("user_id", "ts", ("event_id",), ("event_type",), ("last_value",), ("first_value",))


def event_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", F.col("value").alias("last_value"), F.col("value").alias("first_value"))
    return h.version_chain(events, EVENT_SCD, lineage=("event_id",))


CHAIN = """WITH o AS (
  SELECT *, lag(event_type) OVER w IS DISTINCT FROM event_type OR row_number() OVER w = 1 AS starts,
    last_value(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last_v,
    first_value(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS first_v
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
), g AS (SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS version FROM o
), v AS (
  SELECT user_id, version, any_value(event_type) AS event_type, any_value(last_v) AS last_value, any_value(first_v) AS first_value,
    arg_max(event_id, (ts, event_id)) AS event_id, min(ts) AS valid_from FROM g GROUP BY user_id, version
), chain AS (
  SELECT user_id, event_type, last_value, first_value, event_id, valid_from, lead(version) OVER x IS NULL AS is_current,
    coalesce(lead(valid_from) OVER x, TIMESTAMP '9999-12-31') AS valid_to FROM v WINDOW x AS (PARTITION BY user_id ORDER BY version)
)"""


@query(CHAIN + " SELECT * FROM chain")
def scd2_chain(spark, sf_dir):
    return event_versions(spark, sf_dir)


@query(CHAIN + " SELECT user_id, event_type, last_value, first_value, valid_from FROM chain WHERE is_current")
def scd2_current(spark, sf_dir):
    return event_versions(spark, sf_dir).filter("is_current").select("user_id", "event_type", "last_value", "first_value", "valid_from")


@query(CHAIN + " SELECT user_id, event_type, valid_from, valid_to FROM chain WHERE valid_from <= TIMESTAMP '2024-01-15' AND TIMESTAMP '2024-01-15' < valid_to")
def scd2_point_in_time(spark, sf_dir):
    return h.as_of(event_versions(spark, sf_dir), "2024-01-15 00:00:00").select("user_id", "event_type", "valid_from", "valid_to")


@query(CHAIN + " SELECT e.event_id, e.user_id, c.event_type AS state FROM events e JOIN chain c ON e.user_id = c.user_id AND e.ts >= c.valid_from AND e.ts < c.valid_to WHERE e.event_type = 'purchase'")
def scd2_interval_join(spark, sf_dir):
    """The state of a user at each purchase: an equi-join on the user, with the interval as residual."""
    chain = event_versions(spark, sf_dir).select(F.col("user_id").alias("_user"), F.col("event_type").alias("state"), "valid_from", "valid_to")
    bought = table(spark, sf_dir, "events").filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return bought.join(chain, (F.col("user_id") == F.col("_user")) & (F.col("ts") >= F.col("valid_from")) & (F.col("ts") < F.col("valid_to"))).select("event_id", "user_id", "state")


@query(CHAIN + " SELECT user_id, valid_from, valid_to FROM (SELECT *, lead(valid_from) OVER (PARTITION BY user_id ORDER BY valid_from, valid_to) AS nxt FROM chain WHERE valid_from < valid_to) WHERE nxt < valid_to")
def scd2_overlap_check(spark, sf_dir):
    return q.overlaps(event_versions(spark, sf_dir), "user_id").select("user_id", "valid_from", "valid_to")


def _snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    bronze = bronze_orders(spark, sf_dir)
    return bronze.filter("_run_id < 7"), bronze, bronze.filter("_run_id = 7")


GONE = f"""{BRONZE}, gone AS (
  SELECT DISTINCT o_custkey FROM bronze WHERE _run_id < 7 AND o_custkey NOT IN (SELECT o_custkey FROM bronze WHERE _run_id = 7)
)"""


@query(f"WITH {GONE} SELECT o_custkey FROM gone")
def scd_vanished_keys(spark, sf_dir):
    return h.vanished(*_snapshots(spark, sf_dir), "o_custkey")


@query(f"WITH {GONE}, c AS (SELECT (SELECT count(DISTINCT o_custkey) FROM bronze WHERE _run_id < 7) AS current_count, (SELECT count(*) FROM gone) AS vanished_count) SELECT *, CASE WHEN current_count = 0 THEN 0.0 ELSE vanished_count::DOUBLE / current_count END AS ratio, CASE WHEN current_count = 0 THEN 0.0 ELSE vanished_count::DOUBLE / current_count END > 0.1 AS tripped FROM c")
def mass_delete_ratio(spark, sf_dir):
    current, bronze, snapshot = _snapshots(spark, sf_dir)
    return h.mass_delete(current, h.vanished(current, bronze, snapshot, "o_custkey"), "o_custkey", 0.1)


ORDER_SCD = h.Scd("o_custkey", "event_ts", ("_source_row_number",), ("o_orderstatus",))
GOLD = f"""{GONE}, o AS (
  SELECT *, lag(o_orderstatus) OVER w IS DISTINCT FROM o_orderstatus OR row_number() OVER w = 1 AS starts FROM bronze WHERE _run_id < 7
  WINDOW w AS (PARTITION BY o_custkey ORDER BY event_ts, _source_row_number)
), s AS (SELECT o_custkey, o_orderstatus, event_ts, _source_row_number FROM o WHERE starts), gold AS (
  SELECT o_custkey, o_orderstatus, event_ts AS valid_from, coalesce(lead(event_ts) OVER w, TIMESTAMP '9999-12-31') AS valid_to, lead(event_ts) OVER w IS NULL AS is_current
  FROM s WINDOW w AS (PARTITION BY o_custkey ORDER BY event_ts, _source_row_number)
), hit AS (
  SELECT gold.*, is_current AND g.o_custkey IS NOT NULL AS gone, greatest(TIMESTAMP '2001-01-01', valid_from) AS closing FROM gold LEFT JOIN gone g USING (o_custkey)
), closed AS (SELECT o_custkey, o_orderstatus, valid_from, CASE WHEN gone THEN closing ELSE valid_to END AS valid_to, is_current AND NOT gone AS is_current, FALSE AS is_deleted FROM hit
), opened AS (SELECT o_custkey, o_orderstatus, closing AS valid_from, TIMESTAMP '9999-12-31' AS valid_to, TRUE AS is_current, TRUE AS is_deleted FROM hit WHERE gone)"""


def _deleted(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    current, bronze, snapshot = _snapshots(spark, sf_dir)
    gone = h.vanished(current, bronze, snapshot, "o_custkey")
    return h.apply_deletes(h.version_chain(current, ORDER_SCD), gone, "o_custkey", F.lit("2001-01-01").cast("timestamp"), mode)


@query(f"WITH {GOLD} SELECT * FROM closed")
def scd_delete_invalidate(spark, sf_dir):
    return _deleted(spark, sf_dir, "invalidate")


@query(f"WITH {GOLD} SELECT * FROM closed UNION ALL SELECT * FROM opened")
def scd_delete_new_record(spark, sf_dir):
    return _deleted(spark, sf_dir, "new_record")


@query(f"WITH {GOLD} SELECT *, FALSE AS is_deleted FROM gold")
def scd_delete_ignore(spark, sf_dir):
    return _deleted(spark, sf_dir, "ignore")


@query(f"""WITH {BRONZE}, o AS (
  SELECT *, lag(o_orderstatus) OVER w IS DISTINCT FROM o_orderstatus OR row_number() OVER w = 1 AS starts FROM bronze
  WHERE _run_id < 7 OR o_custkey IN (SELECT o_custkey FROM bronze WHERE _run_id = 7) WINDOW w AS (PARTITION BY o_custkey ORDER BY event_ts, _source_row_number)
), s AS (SELECT o_custkey, o_orderstatus, event_ts, _source_row_number FROM o WHERE starts)
SELECT o_custkey, o_orderstatus, event_ts AS valid_from, coalesce(lead(event_ts) OVER w, TIMESTAMP '9999-12-31') AS valid_to, lead(event_ts) OVER w IS NULL AS is_current, FALSE AS is_deleted
FROM s WINDOW w AS (PARTITION BY o_custkey ORDER BY event_ts, _source_row_number)""")
def scd_publish(spark, sf_dir):
    current, bronze, snapshot = _snapshots(spark, sf_dir)
    return h.publish_scd(h.version_chain(current, ORDER_SCD), bronze, snapshot, ORDER_SCD, "ignore", 1.0, F.lit("2001-01-01").cast("timestamp"))


@query(f"""WITH {BRONZE}, res AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY event_ts DESC, _source_row_number DESC) AS rn FROM bronze WHERE _run_id <= 4) WHERE rn = 1
), inc AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY event_ts DESC NULLS FIRST, _source_row_number DESC) AS rn FROM bronze WHERE _run_id > 4) WHERE rn = 1
), j AS (
  SELECT r.o_custkey AS rk, i.o_custkey AS ik, r.o_orderstatus AS rs, i.o_orderstatus AS ist, r.event_ts AS rt, i.event_ts AS it,
    CASE WHEN r.o_custkey IS NULL THEN 'inserted' WHEN i.o_custkey IS NOT NULL AND i._record_hash IS DISTINCT FROM r._record_hash AND coalesce(i.event_ts >= r.event_ts, FALSE) THEN 'updated' ELSE 'kept' END AS _action
  FROM res r FULL OUTER JOIN inc i ON r.o_custkey = i.o_custkey
) SELECT CASE WHEN _action = 'kept' THEN rk ELSE ik END AS o_custkey, CASE WHEN _action = 'kept' THEN rs ELSE ist END AS o_orderstatus, CASE WHEN _action = 'kept' THEN rt ELSE it END AS event_ts, _action FROM j""")
def upsert_hash_guarded(spark, sf_dir):
    bronze = bronze_orders(spark, sf_dir)
    resident = h.winners(bronze.filter("_run_id <= 4"), ["o_custkey"], h.newest_first("event_ts", "_source_row_number"))
    return h.upsert(resident, bronze.filter("_run_id > 4"), "o_custkey", "event_ts", ties=("_source_row_number",)).select("o_custkey", "o_orderstatus", "event_ts", "_action")


@query(f"""WITH {BRONZE}, nulled AS (SELECT * REPLACE (CASE WHEN o_custkey % 5 = 0 OR _source_row_number % 7 = 0 THEN NULL ELSE event_ts END AS event_ts) FROM bronze), res AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY event_ts DESC NULLS LAST, _source_row_number DESC) AS rn FROM nulled WHERE _run_id <= 4) WHERE rn = 1
), inc AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY event_ts DESC NULLS LAST, _source_row_number DESC) AS rn FROM nulled WHERE _run_id > 4) WHERE rn = 1
), j AS (
  SELECT r.o_custkey AS rk, i.o_custkey AS ik, r.o_orderstatus AS rs, i.o_orderstatus AS ist, r.event_ts AS rt, i.event_ts AS it,
    CASE WHEN r.o_custkey IS NULL THEN 'inserted' WHEN i.o_custkey IS NOT NULL AND i._record_hash IS DISTINCT FROM r._record_hash AND (r.event_ts IS NULL OR coalesce(i.event_ts >= r.event_ts, FALSE)) THEN 'updated' ELSE 'kept' END AS _action
  FROM res r FULL OUTER JOIN inc i ON r.o_custkey = i.o_custkey
) SELECT CASE WHEN _action = 'kept' THEN rk ELSE ik END AS o_custkey, CASE WHEN _action = 'kept' THEN rs ELSE ist END AS o_orderstatus, CASE WHEN _action = 'kept' THEN rt ELSE it END AS event_ts, _action FROM j""")
def upsert_null_branch(spark, sf_dir):
    bronze = bronze_orders(spark, sf_dir).withColumn("event_ts", F.when((F.col("o_custkey") % 5 == 0) | (F.col("_source_row_number") % 7 == 0), F.lit(None)).otherwise(F.col("event_ts")))
    resident = h.winners(bronze.filter("_run_id <= 4"), ["o_custkey"], h.newest_first("event_ts", "_source_row_number"))
    return h.upsert(resident, bronze.filter("_run_id > 4"), "o_custkey", "event_ts", null_loses=True, ties=("_source_row_number",)).select("o_custkey", "o_orderstatus", "event_ts", "_action")


def _shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("o_orderkey") % 97 == 0, F.col("o_custkey") + 100000).otherwise(F.col("o_custkey"))
    return table(spark, sf_dir, "orders").select("o_orderkey", key.alias("custkey"))


SHIFTED = "shifted AS (SELECT o_orderkey, CASE WHEN o_orderkey % 97 = 0 THEN o_custkey + 100000 ELSE o_custkey END AS custkey FROM orders)"


@query(f"WITH {SHIFTED} SELECT s.*, 'REFERENTIAL_ORPHAN' AS error_type FROM shifted s LEFT JOIN customer ON c_custkey = custkey WHERE c_custkey IS NULL")
def referential_orphans(spark, sf_dir):
    return q.orphans(_shifted(spark, sf_dir), table(spark, sf_dir, "customer"), "custkey", "c_custkey").withColumn("error_type", F.lit("REFERENTIAL_ORPHAN"))


@query(f"WITH {SHIFTED} SELECT * FROM shifted WHERE custkey IN (SELECT c_custkey FROM customer)")
def referential_keepers(spark, sf_dir):
    return q.keepers(_shifted(spark, sf_dir), table(spark, sf_dir, "customer"), "custkey", "c_custkey")


def dirty_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.alias("ordinal"),
        F.when(k % 11 == 0, "").when(k % 13 == 0, F.lit(None)).otherwise(F.col("c_name")).alias("name"),
        F.when(k % 7 == 0, F.concat("c_mktsegment", F.lit("\n"))).when(k % 17 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(k % 19 == 0, "n/a").when(k % 23 == 0, "1_000").otherwise(F.col("c_nationkey").cast("string")).alias("nation"),
        F.concat(F.lit("u"), (k % 900).cast("string")).alias("code"),
    )


DIRTY_CUSTOMERS = r"""dirty AS (SELECT c_custkey AS ordinal,
  CASE WHEN c_custkey % 11 = 0 THEN '' WHEN c_custkey % 13 = 0 THEN NULL ELSE c_name END AS name,
  CASE WHEN c_custkey % 7 = 0 THEN c_mktsegment || chr(10) WHEN c_custkey % 17 = 0 THEN NULL ELSE c_mktsegment END AS segment,
  CASE WHEN c_custkey % 19 = 0 THEN 'n/a' WHEN c_custkey % 23 = 0 THEN '1_000' ELSE CAST(c_nationkey AS VARCHAR) END AS nation,
  'u' || (c_custkey % 900) AS code FROM customer
), judged AS (SELECT *,
  CASE WHEN name IS NULL OR name = '' THEN 'COMPLETENESS_VIOLATION' END AS e1,
  CASE WHEN NOT regexp_full_match(coalesce(segment, ''), '[A-Z]+') THEN 'PATTERN_VIOLATION' END AS e2,
  CASE WHEN nation LIKE '%\_%' ESCAPE '\' OR try_cast(nation AS DOUBLE) IS NULL THEN 'VALIDITY_RANGE_UNPARSEABLE' WHEN try_cast(nation AS DOUBLE) < 2 OR try_cast(nation AS DOUBLE) > 20 THEN 'VALIDITY_RANGE_VIOLATION' END AS e3,
  CASE WHEN row_number() OVER (PARTITION BY ordinal // 1000, code ORDER BY ordinal) > 1 THEN 'UNIQUENESS_VIOLATION' END AS e4 FROM dirty
)"""
CUSTOMER_RULES = (
    q.Rule("completeness", "name"),
    q.Rule("pattern", "segment", "QUARANTINE_RECORD", {"regex": "[A-Z]+"}),
    q.Rule("validity_range", "nation", "WARN_AND_CONTINUE", {"low": 2.0, "high": 20.0}),
    q.Rule("uniqueness", "code"),
)


@query(f"WITH {DIRTY_CUSTOMERS} SELECT ordinal, name, e1 AS error FROM judged")
def completeness_split(spark, sf_dir):
    return dirty_customers(spark, sf_dir).select("ordinal", "name", q.completeness(F.col("name")).alias("error"))


@query(f"WITH {DIRTY_CUSTOMERS} SELECT ordinal, segment, e2 AS error FROM judged")
def pattern_split(spark, sf_dir):
    return dirty_customers(spark, sf_dir).select("ordinal", "segment", q.pattern(F.col("segment"), "[A-Z]+").alias("error"))


@query(f"WITH {DIRTY_CUSTOMERS} SELECT ordinal, nation, e3 AS error FROM judged")
def range_split(spark, sf_dir):
    return dirty_customers(spark, sf_dir).select("ordinal", "nation", q.validity_range(F.col("nation"), 2.0, 20.0).alias("error"))


@query(f"WITH {DIRTY_CUSTOMERS} SELECT ordinal, code, e4 AS error FROM judged")
def uniqueness_chunk_split(spark, sf_dir):
    return dirty_customers(spark, sf_dir).select("ordinal", "code", q.uniqueness(F.col("code"), F.col("ordinal")).alias("error"))


@query(f"WITH {DIRTY_CUSTOMERS} SELECT ordinal, coalesce(e1, e2, e4) AS error_type, CASE WHEN e1 IS NOT NULL THEN 'name' WHEN e2 IS NOT NULL THEN 'segment' ELSE 'code' END AS error_column FROM judged WHERE coalesce(e1, e2, e4) IS NOT NULL")
def quality_rejects(spark, sf_dir):
    return q.split(dirty_customers(spark, sf_dir), CUSTOMER_RULES, "ordinal").rejects.select("ordinal", "error_type", "error_column")


@query(f"WITH {DIRTY_CUSTOMERS} SELECT ordinal, name, segment, nation, code FROM judged WHERE coalesce(e1, e2, e4) IS NULL")
def quality_keepers(spark, sf_dir):
    return q.split(dirty_customers(spark, sf_dir), CUSTOMER_RULES, "ordinal").good


FINDINGS = f"""WITH {DIRTY_CUSTOMERS}, f AS (
  SELECT 'COMPLETENESS' AS rule_type, 'name' AS rule_column, 'REJECT_RECORD' AS strategy, count(*) AS evaluated, count(e1) AS failed FROM judged
  UNION ALL SELECT 'PATTERN', 'segment', 'QUARANTINE_RECORD', count(*), count(e2) FROM judged
  UNION ALL SELECT 'VALIDITY_RANGE', 'nation', 'WARN_AND_CONTINUE', count(*), count(e3) FROM judged
  UNION ALL SELECT 'UNIQUENESS', 'code', 'REJECT_RECORD', count(*), count(e4) FROM judged
)"""


@query(FINDINGS + " SELECT rule_type, rule_column, strategy, CASE WHEN failed = 0 THEN 'PASS' WHEN strategy = 'WARN_AND_CONTINUE' THEN 'PASS_WITH_WARNING' ELSE 'FAIL' END AS status, evaluated, failed FROM f")
def quality_findings(spark, sf_dir):
    return q.findings(q.judge(dirty_customers(spark, sf_dir), CUSTOMER_RULES, "ordinal"), CUSTOMER_RULES)


@query(FINDINGS + " SELECT rule_type, rule_column, CASE WHEN evaluated = 0 THEN 0.0 ELSE failed::DOUBLE / evaluated END AS ratio, CASE WHEN evaluated = 0 THEN 0.0 ELSE failed::DOUBLE / evaluated END > 0.1 AS tripped FROM f")
def rejection_ratio_by_rule(spark, sf_dir):
    found = q.findings(q.judge(dirty_customers(spark, sf_dir), CUSTOMER_RULES, "ordinal"), CUSTOMER_RULES)
    return found.select("rule_type", "rule_column", q.ratio(F.col("failed"), F.col("evaluated")).alias("ratio")).withColumn("tripped", F.col("ratio") > 0.1)


@query("""WITH d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1), w AS (
  SELECT *, avg(n) OVER x AS mean, count(n) OVER x AS history FROM d WINDOW x AS (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
) SELECT day, n, round(mean, 6) AS baseline, history, history >= 2 AND n > 1.05 * coalesce(mean, 0) AS anomalous FROM w""")
def volume_anomaly_daily(spark, sf_dir):
    days = table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return q.volume_anomalies(days, "day", "n", 1.05).withColumn("baseline", F.round("baseline", 6))


@query("SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2 HAVING count(*) > 1")
def unique_key_check(spark, sf_dir):
    return q.key_violations(table(spark, sf_dir, "events"), ["user_id", "event_type"])


# Normalisers over texts made from orders.

NUMBER_TEXT = "CASE o_orderkey % 8 WHEN 0 THEN '(' || s || ')' WHEN 1 THEN s || '-' WHEN 2 THEN s || ' %' WHEN 3 THEN '€' || s WHEN 4 THEN '1.2E+14' WHEN 5 THEN '' WHEN 6 THEN '-1' ELSE s END"


def number_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of orders as German texts, in eight notations."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    whole, part = F.floor(cents / 100).cast("string"), F.lpad((cents % 100).cast("string"), 2, "0")
    grouped = F.regexp_replace(whole, r"(?<=[0-9])(?=(?:[0-9]{3})+$)", ".")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.concat(grouped, F.lit(","), part).alias("s")).select("o_orderkey", F.expr(NUMBER_TEXT).alias("raw"))


NUMBERS = f"""c AS (SELECT o_orderkey, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders), t AS (
  SELECT o_orderkey, reverse(regexp_replace(regexp_replace(reverse(CAST(cents // 100 AS VARCHAR)), '([0-9]{{3}})', '\\1.', 'g'), '\\.$', '')) || ',' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0') AS s, cents FROM c
), raw AS (SELECT o_orderkey, {NUMBER_TEXT} AS raw, cents FROM t)"""


def _decimal_sql(case: str) -> str:
    """A decimal without trailing zeros, as text."""
    return f"regexp_replace(regexp_replace(CAST({case} AS VARCHAR), '(\\.[0-9]*?)0+$', '\\1'), '\\.$', '')"


GERMAN = {"decimal_separator": ",", "thousands_separator": ".", "currency_symbols": ("€",)}


def _numbers(spark: SparkSession, sf_dir: str, **profile) -> DataFrame:
    return number_texts(spark, sf_dir).select("o_orderkey", "raw", n.decimal(F.col("raw"), n.NumberProfile(**GERMAN, **profile)).alias("d")).select("o_orderkey", "raw", "d.value", "d.error")


#: What each notation gives; one that the profile doesn't know is an error.
PLAIN = _decimal_sql("cents // 100 || '.' || lpad(CAST(cents % 100 AS VARCHAR), 2, '0')")
HUNDREDTH = _decimal_sql("cents // 10000 || '.' || lpad(CAST(cents % 10000 AS VARCHAR), 4, '0')")


def _numbers_sql(zero: str = "NULL", one: str = "NULL", two: str = PLAIN) -> str:
    return f"""CASE o_orderkey % 8 WHEN 0 THEN {zero} WHEN 1 THEN {one} WHEN 2 THEN {two} WHEN 3 THEN {PLAIN} WHEN 4 THEN '1200000000000000' WHEN 6 THEN '-1' WHEN 7 THEN {PLAIN} END AS value,
  CASE WHEN o_orderkey % 8 IN (5{', 0' if zero == 'NULL' else ''}{', 1' if one == 'NULL' else ''}) THEN 'invalid-numeric-value' END AS error FROM raw"""


@query(f"WITH {NUMBERS} SELECT o_orderkey, raw, {_numbers_sql()}")
def decimal_locale(spark, sf_dir):
    return _numbers(spark, sf_dir)


@query(f"WITH {NUMBERS} SELECT o_orderkey, {_numbers_sql(two=HUNDREDTH)}")
def percent_fraction(spark, sf_dir):
    return _numbers(spark, sf_dir, percent_as_fraction=True).select("o_orderkey", "value", "error")


@query(f"""WITH {NUMBERS} SELECT o_orderkey, 'leading-minus' AS style, {_numbers_sql()}
UNION ALL SELECT o_orderkey, 'parentheses', {_numbers_sql(zero=f"'-' || {PLAIN}")}
UNION ALL SELECT o_orderkey, 'trailing-minus', {_numbers_sql(one=f"'-' || {PLAIN}")}""")
def negative_styles(spark, sf_dir):
    styles = ("leading-minus", "parentheses", "trailing-minus")
    each = [_numbers(spark, sf_dir, negative_style=s).select("o_orderkey", F.lit(s).alias("style"), "value", "error") for s in styles]
    return each[0].unionByName(each[1]).unionByName(each[2])


@query("SELECT l_orderkey, l_linenumber, CAST(l_partkey AS VARCHAR) || '.' || lpad(CAST(l_suppkey AS VARCHAR), 12, '0') || '7' AS value, '0.' || repeat('0', 19) || l_partkey || '7' AS tiny, repeat('9', 40) || '.5' AS long FROM lineitem")
def decimal_exact(spark, sf_dir):
    """Numbers of more places, and more digits, than any decimal type holds."""
    part, supplier = F.col("l_partkey").cast("string"), F.lpad(F.col("l_suppkey").cast("string"), 12, "0")
    places = n.decimal(F.concat(part, F.lit("."), supplier, F.lit("70")))["value"]
    tiny = n.decimal(F.concat(part, F.lit("7E-"), F.length(part) + 20))["value"]
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", places.alias("value"), tiny.alias("tiny"), n.decimal(F.lit("9" * 40 + ".50"))["value"].alias("long"))


@query(f"WITH {NUMBERS} SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (0, 1, 2, 3, 7) OR raw IN ('', '-1') THEN NULL ELSE '1200000000000000' END AS value, CASE WHEN o_orderkey % 8 IN (0, 1) THEN 'invalid-numeric-value' END AS error FROM raw WHERE o_orderkey % 8 IN (0, 1, 4, 5, 6) UNION ALL SELECT o_orderkey, {PLAIN}, NULL FROM raw WHERE o_orderkey % 8 IN (2, 3, 7)")
def numeric_sentinels(spark, sf_dir):
    """Empty and -1 stand for no number."""
    return _numbers(spark, sf_dir, null_sentinels=("", "-1")).select("o_orderkey", "value", "error")


@query(f"WITH {NUMBERS} SELECT o_orderkey, CASE WHEN regexp_full_match(raw, '-?[0-9](\\.[0-9]+)?[eE][+-]?[0-9]+') THEN 'scientific-notation-identifier-unrecoverable' WHEN o_orderkey % 8 IN (0, 1, 5) THEN 'invalid-numeric-value' END AS error FROM raw")
def sci_notation_guard(spark, sf_dir):
    return _numbers(spark, sf_dir, reject_scientific=True).select("o_orderkey", "error")


@query("SELECT p_partkey, CASE WHEN length(CAST(p_partkey AS VARCHAR)) < 3 THEN 'fixed-width-identifier-below-declared-width' END AS error FROM part")
def fixed_width_guard(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", n.decimal(F.col("p_partkey").cast("string"), n.NumberProfile(fixed_width=3))["error"].alias("error"))


@query(f"WITH {NUMBERS} SELECT o_orderkey, nullif(nullif(raw, ''), '-1') AS value FROM raw")
def null_tokens(spark, sf_dir):
    return number_texts(spark, sf_dir).select("o_orderkey", n.null_tokens(F.col("raw"), ("", "-1")).alias("value"))


@query("SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'True' WHEN 'F' THEN 'False' END AS value, CASE WHEN o_orderstatus = 'O' AND o_orderkey % 10 <> 0 THEN 'unmapped-boolean-token' END AS error FROM orders")
def boolean_tokens(spark, sf_dir):
    token = F.when(F.col("o_orderstatus") == "P", "Tak").when(F.col("o_orderstatus") == "F", "Nie").when(F.col("o_orderkey") % 10 != 0, "może")
    return table(spark, sf_dir, "orders").select("o_orderkey", n.boolean(token, ("Tak",), ("Nie",)).alias("b")).select("o_orderkey", "b.value", "b.error")


@query("""SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL ELSE strftime(o_orderdate, '%Y-%m-%d') END AS value,
  CASE WHEN o_orderkey % 4 = 3 THEN 'invalid-calendar-date' END AS error FROM orders""")
def date_formats(spark, sf_dir):
    k, d = F.col("o_orderkey") % 4, F.col("o_orderdate")
    texts = [F.date_format(d, "yyyy-MM-dd"), F.date_format(d, "d/M/yyyy"), F.date_format(d, "dd MMM yyyy"), F.lit("2024-02-30")]
    parsed = [n.date(texts[0]), n.date(texts[1], "%d/%m/%Y"), n.date(texts[2], "%d %b %Y"), n.date(texts[3])]
    picked = F.when(k == 0, parsed[0]).when(k == 1, parsed[1]).when(k == 2, parsed[2]).otherwise(parsed[3])
    return table(spark, sf_dir, "orders").select("o_orderkey", picked.alias("p")).select("o_orderkey", "p.value", "p.error")


@query("SELECT o_orderkey, CASE WHEN year(o_orderdate) % 100 <= 97 THEN 2000 ELSE 1900 END + year(o_orderdate) % 100 || strftime(o_orderdate, '-%m-%d') AS value, NULL::VARCHAR AS error FROM orders")
def two_digit_year(spark, sf_dir):
    parsed = n.date(F.date_format("o_orderdate", "dd-MM-yy"), "%d-%m-%y", pivot=97)
    return table(spark, sf_dir, "orders").select("o_orderkey", parsed.alias("p")).select("o_orderkey", "p.value", "p.error")


@query("""SELECT o_orderkey, o_orderkey % 120 AS serial, CASE WHEN o_orderkey % 120 = 60 THEN NULL WHEN o_orderkey % 120 < 60 THEN strftime(DATE '1899-12-31' + CAST(o_orderkey % 120 AS INT), '%Y-%m-%d') ELSE strftime(DATE '1899-12-30' + CAST(o_orderkey % 120 AS INT), '%Y-%m-%d') END AS day_1900,
  strftime(DATE '1904-01-01' + CAST(o_orderkey % 120 AS INT), '%Y-%m-%d') AS day_1904, CASE WHEN o_orderkey % 120 = 60 THEN 'spreadsheet-serial-date-does-not-exist' END AS error FROM orders""")
def excel_serial(spark, sf_dir):
    text = F.col("serial").cast("string")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 120).alias("serial"))
    return orders.select("o_orderkey", "serial", n.serial_date(text)["value"].alias("day_1900"), n.serial_date(text, "1904")["value"].alias("day_1904"), n.serial_date(text)["error"].alias("error"))


@query("""SELECT event_id, strftime(ts - INTERVAL 2 HOUR, '%Y-%m-%dT%H:%M:%S+00:00') AS value FROM events""")
def offset_to_utc(spark, sf_dir):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.when(F.col("event_id") % 2 == 0, "+02:00").otherwise("+0200"))
    return table(spark, sf_dir, "events").select("event_id", n.date(text, "%Y-%m-%dT%H:%M:%S%z")["value"].alias("value"))


@query("SELECT event_id, 'naive-timestamp-without-a-declared-zone' AS error FROM events")
def naive_timestamps(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", n.date(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), "%Y-%m-%d %H:%M:%S")["error"].alias("error"))


@query("""WITH w AS (SELECT o_orderkey, TIMESTAMP '2026-03-29 00:30:00' + INTERVAL (o_orderkey % 12) HOUR + CASE WHEN o_orderkey % 2 = 1 THEN INTERVAL 210 DAY ELSE INTERVAL 0 DAY END AS wall FROM orders)
SELECT o_orderkey, CASE WHEN wall >= TIMESTAMP '2026-03-29 02:00:00' AND wall < TIMESTAMP '2026-03-29 03:00:00' THEN 'nonexistent'
  WHEN wall >= TIMESTAMP '2026-10-25 02:00:00' AND wall < TIMESTAMP '2026-10-25 03:00:00' THEN 'ambiguous' ELSE 'unambiguous' END AS kind FROM w""")
def dst_classify(spark, sf_dir):
    k = F.col("o_orderkey")
    wall = F.timestamp_seconds(F.unix_timestamp(F.lit("2026-03-29 00:30:00").cast("timestamp")) + (k % 12) * 3600 + F.when(k % 2 == 1, 210 * 86400).otherwise(0))
    return table(spark, sf_dir, "orders").select("o_orderkey", n.classify_local(wall, "Europe/Warsaw").alias("kind"))


@query("SELECT doc_id, nfc_normalize(text || ' e' || chr(769) || ' A' || chr(778)) AS text FROM documents")
def unicode_nfc(spark, sf_dir):
    text = F.concat("text", F.lit(" é Å"))
    return table(spark, sf_dir, "documents").select("doc_id", n.nfc(text).alias("text"))


@query("SELECT c_custkey, sha256(concat_ws('|', c_name, coalesce(nullif(c_mktsegment, 'BUILDING'), ''), CASE WHEN c_acctbal > 0 THEN 'True' ELSE 'False' END)) AS record_hash FROM customer")
def record_hash(spark, sf_dir):
    flag = n.field_text(F.col("c_acctbal") > 0, "boolean")
    return table(spark, sf_dir, "customer").select("c_custkey", n.record_hash(F.col("c_name"), F.nullif("c_mktsegment", F.lit("BUILDING")), flag).alias("record_hash"))


@query("SELECT lower(lpad(to_hex(bit_xor(('0x' || substr(md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus)), 1, 16))::UBIGINT)), 16, '0')) AS checksum, count(*) AS rows FROM orders")
def table_checksum(spark, sf_dir):
    return r.table_checksum(table(spark, sf_dir, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus"])


def _profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    lines = table(spark, sf_dir, "lineitem")
    return r.reconcile(r.profile(orders, "o_orderkey", "o_orderdate", "o_totalprice"), r.profile(lines, "l_orderkey", "l_shipdate", "l_extendedprice"), "orders_lineitem")


PROFILES = """WITH a AS (SELECT count(*) AS r, count(DISTINCT o_orderkey) AS k, min(o_orderdate) AS lo, max(o_orderdate) AS hi, sum(CAST(o_totalprice AS DECIMAL(38,2))) AS t FROM orders),
b AS (SELECT count(*) AS r, count(DISTINCT l_orderkey) AS k, min(l_shipdate) AS lo, max(l_shipdate) AS hi, sum(CAST(l_extendedprice AS DECIMAL(38,2))) AS t FROM lineitem)"""


@query(PROFILES + " SELECT 'orders_lineitem' AS hop, a.r AS rows_input, b.r AS rows_output, a.r - b.r AS discrepancy, CAST(a.t AS DOUBLE) AS total_input, CAST(b.t AS DOUBLE) AS total_output FROM a, b")
def reconcile_counts_sums(spark, sf_dir):
    return _profiles(spark, sf_dir).select("hop", "rows_input", "rows_output", "discrepancy", F.col("total_input").cast("double").alias("total_input"), F.col("total_output").cast("double").alias("total_output"))


@query(PROFILES + " SELECT a.k AS keys_input, b.k AS keys_output, a.lo AS min_ts_input, b.lo AS min_ts_output, a.hi AS max_ts_input, b.hi AS max_ts_output FROM a, b")
def reconcile_minmax_keys(spark, sf_dir):
    return _profiles(spark, sf_dir).select("keys_input", "keys_output", "min_ts_input", "min_ts_output", "max_ts_input", "max_ts_output")


@query(f"""WITH {BRONZE}, old AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY {NEWEST_SQL}) AS rn FROM bronze WHERE _run_id <= 4) WHERE rn = 1), {WINNERS}, counts AS (
  SELECT (SELECT count(*) FROM bronze) AS input_count, (SELECT count(*) FROM winners) AS output_count,
    (SELECT count(*) FROM bronze WHERE _run_id <= 4) - (SELECT count(*) FROM old) + (SELECT count(*) FROM bronze b JOIN winners w USING (o_custkey) WHERE b._run_id > 4 AND NOT (b._file_id = w._file_id AND b._source_row_number = w._source_row_number)) AS dedup_count,
    (SELECT count(*) FROM old o JOIN winners w USING (o_custkey) WHERE w._run_id > 4) AS displaced_count
) SELECT DISTINCT b._file_id AS file_id, c.*, input_count - (output_count + dedup_count) AS discrepancy, input_count - (output_count + dedup_count) - displaced_count AS corrected FROM bronze b, counts c WHERE b._run_id > 4""")
def reconcile_bronze_silver(spark, sf_dir):
    bronze = bronze_orders(spark, sf_dir)
    files = bronze.filter("_run_id > 4").select(F.col("_file_id").alias("file_id"))
    return r.reconcile_dedup(files, h.dedup_counts(bronze, ["o_custkey"], newest(), 4))


@query(f"WITH {BRONZE} SELECT _run_id, count(*) AS output_count, CAST(CASE WHEN _run_id % 2 = 1 THEN 2000 + _run_id END AS BIGINT) AS expected_row_count, CASE WHEN _run_id % 2 = 1 THEN 2000 + _run_id END - count(*) AS control_total_discrepancy FROM bronze GROUP BY _run_id")
def control_total_check(spark, sf_dir):
    outputs = bronze_orders(spark, sf_dir).groupBy("_run_id").agg(F.count("*").alias("output_count"))
    manifests = spark.range(1, 10, 2).select(F.col("id").cast("int").alias("_run_id"), (F.col("id") + 2000).alias("expected_row_count"))
    return r.control_total(outputs, manifests, "_run_id")


@query(f"""WITH {BRONZE}, m AS (SELECT _run_id, max(event_ts) AS top FROM bronze GROUP BY _run_id) SELECT a._run_id, b.top AS old_value, greatest(a.top, b.top) AS new_value FROM m a LEFT JOIN m b ON b._run_id = CASE WHEN a._run_id % 2 = 0 THEN 7 ELSE NULL END AND a._run_id % 2 = 0""")
def watermark_advance(spark, sf_dir):
    tops = bronze_orders(spark, sf_dir).groupBy("_run_id").agg(F.max("event_ts").alias("value"))
    resident = tops.filter("_run_id % 2 = 0").select("_run_id").join(tops.filter("_run_id = 7").select("value"))
    return r.advance_watermark(resident, tops, "_run_id")


def _meta(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    nation, orders = table(spark, sf_dir, "nation"), table(spark, sf_dir, "orders")
    day = 86400
    datasets = nation.select(
        F.col("n_nationkey").alias("dataset_id"), F.col("n_name").alias("dataset_name"), F.when(F.col("n_nationkey") % 5 != 0, day).alias("expected_frequency"),
        F.when(F.col("n_nationkey") % 3 == 0, day).alias("freshness_warn_after"), F.when(F.col("n_nationkey") % 2 == 0, 3 * day).alias("freshness_fail_after"), F.lit("1994-01-01").cast("timestamp").alias("created_at"),
    )
    files = orders.select((F.col("o_custkey") % 23).cast("int").alias("dataset_id"), F.expr("timestampadd(DAY, -cast(o_custkey % 23 as int), o_orderdate)").alias("discovered_at"))
    runs = orders.select((F.col("o_custkey") % 23).cast("int").alias("dataset_id"), F.when(F.col("o_orderstatus") == "F", "FAILED").otherwise("SUCCEEDED").alias("status"), F.col("o_orderdate").alias("finished_at"))
    return datasets, files, runs


@query("""WITH f AS (SELECT CAST(o_custkey % 23 AS INT) AS dataset_id, max(o_orderdate - INTERVAL (o_custkey % 23) DAY) AS last_file FROM orders GROUP BY 1),
s AS (SELECT CAST(o_custkey % 23 AS INT) AS dataset_id, max(o_orderdate) AS last_success_at FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1),
d AS (SELECT n_nationkey AS dataset_id, n_name AS dataset_name, coalesce(last_file, TIMESTAMP '1994-01-01') AS last_received_at, last_success_at,
  CASE WHEN n_nationkey % 3 = 0 THEN 86400 END AS warn, CASE WHEN n_nationkey % 2 = 0 THEN 259200 END AS fail
  FROM nation LEFT JOIN f ON f.dataset_id = n_nationkey LEFT JOIN s ON s.dataset_id = n_nationkey WHERE n_nationkey % 5 <> 0),
e AS (SELECT *, CAST(epoch(TIMESTAMP '2001-08-02') - epoch(last_received_at) AS BIGINT) AS processing_delay FROM d)
SELECT dataset_id, dataset_name, last_received_at, last_success_at, processing_delay,
  CASE WHEN fail IS NOT NULL AND processing_delay > 86400 + fail THEN 'fail' WHEN processing_delay > 86400 + coalesce(warn, 0) THEN 'warn' ELSE 'ok' END AS freshness_status FROM e""")
def freshness_status(spark, sf_dir):
    return r.freshness(*_meta(spark, sf_dir), F.lit("2001-08-02 00:00:00").cast("timestamp"))


def _runs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A run for each customer, and those of its stages that a rule on its key leaves."""
    key = F.col("c_custkey")
    status = lambda k: F.element_at(F.array(F.lit("SUCCEEDED"), F.lit("FAILED"), F.lit("RUNNING"), F.lit("PENDING")), ((F.floor(key / k) % 4) + 1).cast("int"))
    customers = table(spark, sf_dir, "customer")
    runs = customers.select(key.alias("run_id"), F.when(key % 3 == 0, "SUCCEEDED").otherwise("RUNNING").alias("status"))
    stages = [customers.filter(key % (k + 5) != 0).select(key.alias("run_id"), F.lit(s).alias("stage_name"), status(4**k).alias("status")) for k, s in enumerate(r.STAGES)]
    return runs, stages[0].unionByName(stages[1]).unionByName(stages[2])


RUNS = "r AS (SELECT c_custkey AS run_id, CASE WHEN c_custkey % 3 = 0 THEN 'SUCCEEDED' ELSE 'RUNNING' END AS status, " + ", ".join(f"CASE WHEN c_custkey % {k + 5} <> 0 THEN ['SUCCEEDED', 'FAILED', 'RUNNING', 'PENDING'][(c_custkey // {4**k}) % 4 + 1] END AS s{k}" for k in range(3)) + " FROM customer)"


@query(f"""WITH {RUNS} SELECT run_id, status AS run_status, s0 AS stage_load_status, s1 AS dbt_build_status, s2 AS publish_status,
CASE WHEN status = 'SUCCEEDED' AND s2 = 'SUCCEEDED' THEN 'complete' WHEN s0 IS NULL OR s0 IN ('FAILED', 'PENDING') THEN 'retry stage STAGE_LOAD'
  WHEN s1 IS NULL OR s1 IN ('FAILED', 'PENDING') THEN 'retry stage DBT_BUILD' WHEN s2 IS NULL OR s2 IN ('FAILED', 'PENDING') THEN 'retry stage PUBLISH' ELSE 'in progress' END AS next_action FROM r""")
def run_recovery(spark, sf_dir):
    return r.run_recovery(*_runs(spark, sf_dir))


@query(f"WITH {RUNS} SELECT run_id FROM r WHERE s0 = 'SUCCEEDED' AND (s1 IS NULL OR s1 IN ('FAILED', 'RUNNING'))")
def pending_builds(spark, sf_dir):
    return r.pending_builds(*_runs(spark, sf_dir))


@query(f"""WITH {BRONZE}, {WINNERS} SELECT o_custkey, _run_id, 'run-' || _run_id AS dag_run_id, 'file-' || _file_id || '.csv' AS filename, 'batch-' || _batch_id AS batch_key,
  CAST(CASE WHEN _run_id <= 6 THEN (_run_id + 1) // 2 END AS BIGINT) AS dedup_audit_id, CAST(CASE WHEN _run_id <= 6 THEN 10 * ((_run_id + 1) // 2) END AS BIGINT) AS records_deduplicated FROM winners""")
def lineage_join(spark, sf_dir):
    won = h.winners(bronze_orders(spark, sf_dir), ["o_custkey"], newest())
    ids = lambda n_, name, text, prefix, suffix="": spark.range(1, n_ + 1).select(F.col("id").cast("int").alias(name), F.concat(F.lit(prefix), F.col("id").cast("string"), F.lit(suffix)).alias(text))
    audits = spark.range(1, 4).select(F.col("id").alias("dedup_audit_id"), F.lit("orders").alias("model_name"), (2 * F.col("id") - 1).cast("int").alias("min_run_id"), (2 * F.col("id")).cast("int").alias("max_run_id"), (10 * F.col("id")).alias("records_deduplicated"))
    found = r.lineage(won, ids(7, "run_id", "dag_run_id", "run-"), ids(12, "file_id", "filename", "file-", ".csv"), ids(7, "batch_id", "batch_key", "batch-"), audits, "orders")
    return found.select("o_custkey", "_run_id", "dag_run_id", "filename", "batch_key", "dedup_audit_id", "records_deduplicated")


@query(f"""WITH {BRONZE} SELECT c_custkey AS o_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'RESOLVED' WHEN c_custkey IN (SELECT o_custkey FROM bronze WHERE _run_id = 7) THEN 'REDRIVEN' ELSE 'PENDING' END AS status FROM customer""")
def reject_redrive(spark, sf_dir):
    rejects = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_custkey") % 2 == 0, "RESOLVED").otherwise("PENDING").alias("status"))
    return r.redrive(rejects, bronze_orders(spark, sf_dir).filter("_run_id = 7"), "o_custkey")


def _files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("source").alias("dataset_id"), F.col("doc_id").alias("file_id"), F.sha2(F.col("text").cast("binary"), 256).alias("content_sha256"))


@query("SELECT source AS dataset_id, doc_id AS file_id, nullif(min(doc_id) OVER (PARTITION BY source, text), doc_id) AS duplicate_of_file_id FROM documents")
def file_dedup(spark, sf_dir):
    return r.duplicate_files(_files(spark, sf_dir)).select("dataset_id", "file_id", "duplicate_of_file_id")


@query("SELECT source AS dataset_id, sha256(text) AS content_sha256, min(doc_id) AS first_file_id, count(*) AS n FROM documents GROUP BY source, text HAVING count(*) > 1")
def file_dedup_groups(spark, sf_dir):
    return r.duplicate_groups(_files(spark, sf_dir))


@query("""WITH p AS (SELECT 'part-' || (p_partkey % 40) AS grp, p_partkey // 40 AS idx FROM part WHERE p_partkey % 97 <> 5)
SELECT grp AS "group", min(idx)::INT AS first_index, count(*) AS n, sha256(string_agg(sha256(grp || '.' || idx), '|' ORDER BY idx)) AS group_hash,
  CASE WHEN max(idx) - min(idx) + 1 <> count(*) THEN 'multipart-group-incomplete' END AS error FROM p GROUP BY grp""")
def multipart_groups(spark, sf_dir):
    key = F.col("p_partkey")
    names = table(spark, sf_dir, "part").filter("p_partkey % 97 != 5").select(F.concat(F.lit("part-"), (key % 40).cast("string"), F.lit("."), F.floor(key / 40).cast("string")).alias("name"))
    found = discover.multipart(names.withColumn("path", F.col("name")), r"\A(part-[0-9]+)\.([0-9]+)\z")
    return found.select("group", "first_index", "n", discover.group_hash(F.transform("parts", lambda p: F.sha2(p.cast("binary"), 256))).alias("group_hash"), "error")


@query("""SELECT o_orderkey, 'orders' AS dataset, strftime(o_orderdate, '%Y-%m-%d')::DATE AS business_date, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 1000 END AS seq, CASE WHEN o_orderkey % 10 = 9 THEN 'filename-does-not-match-mask' END AS error FROM orders WHERE o_orderkey % 10 <> 9
UNION ALL SELECT o_orderkey, NULL, NULL, NULL, 'filename-does-not-match-mask' FROM orders WHERE o_orderkey % 10 = 9""")
def filename_facets(spark, sf_dir):
    key = F.col("o_orderkey")
    name = F.concat(F.lit("orders_"), F.date_format("o_orderdate", "yyyyMMdd"), F.when(key % 3 == 0, F.concat(F.lit("_"), F.lpad((key % 1000).cast("string"), 3, "0"))).otherwise(""), F.when(key % 10 == 9, ".txt").otherwise(".csv"))
    mask = detect.compile_mask("{dataset}_{business_date:%Y%m%d}[_{seq:03d}].csv")
    return table(spark, sf_dir, "orders").select(key, name.alias("name")).select("o_orderkey", *mask.columns(F.col("name")), mask.error(F.col("name")).alias("error"))


@query("""SELECT * FROM (VALUES ('c_custkey', 'integer', NULL), ('c_name', 'string', NULL), ('c_acctbal', 'decimal', NULL), ('padded', 'string', 'leading-zero'), ('flag', 'boolean', NULL), ('day', 'date', NULL), ('mixed', 'string', 'mixed-parseable')) t(column_name, suggested_type, red_flag)""")
def infer_column_types(spark, sf_dir):
    k = F.col("c_custkey")
    texts = table(spark, sf_dir, "customer").select(
        k.cast("string").alias("c_custkey"), "c_name", F.col("c_acctbal").cast(MONEY).cast("string").alias("c_acctbal"), F.lpad(k.cast("string"), 8, "0").alias("padded"),
        F.when(k % 2 == 0, "yes").otherwise("0").alias("flag"), F.date_format(F.date_add(F.lit("2020-01-01").cast("date"), (k % 300).cast("int")), "yyyy-MM-dd").alias("day"), F.when(k % 9 == 0, "n/a").otherwise(k.cast("string")).alias("mixed"),
    )
    return detect.infer_types(texts, texts.columns, "yyyy-MM-dd")


@query("""SELECT * FROM (VALUES ('customer_id', 'string', 'string', 0, 0, 'same'), ('name', 'string', 'string', 1, 2, 'moved'), ('country', 'string', 'integer', 2, 1, 'retyped'), ('birth_date', 'date', NULL, 3, NULL, 'removed'), ('email', NULL, 'string', NULL, 3, 'added')) t(name, old_type, new_type, old_position, new_position, change)""")
def schema_drift(spark, sf_dir):
    make = lambda rows: spark.createDataFrame(rows, "name string, type string, position int")
    old = make([("customer_id", "string", 0), ("name", "string", 1), ("country", "string", 2), ("birth_date", "date", 3)])
    new = make([("customer_id", "string", 0), ("country", "integer", 1), ("name", "string", 2), ("email", "string", 3)])
    return detect.schema_drift(old, new)


@query("""WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE day(ts) % 7 <> 3), s AS (SELECT CAST(unnest(range(min(day), max(day) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM d) SELECT day FROM s WHERE day NOT IN (SELECT day FROM d)""")
def processing_gaps(spark, sf_dir):
    days = table(spark, sf_dir, "events").filter("day(ts) % 7 != 3").select(F.to_date("ts").alias("day"))
    return r.gaps(days, "day")


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_object('type', event_type, 'user', user_id)::VARCHAR AS summary FROM events")
def json_props_extract(spark, sf_dir):
    made = F.to_json(F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user")))
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), made.alias("summary"))


@query("SELECT doc_id, sha256(concat_ws('|', source, sha256(text), 'config-1', 'image-2', '3', '4')) AS idempotency_key FROM documents")
def idempotency_key(spark, sf_dir):
    files = _files(spark, sf_dir)
    return files.select(F.col("file_id").alias("doc_id"), r.idempotency_key(F.col("dataset_id"), F.col("content_sha256"), F.lit("config-1"), F.lit("image-2"), F.lit(3), F.lit(4)).alias("idempotency_key"))


# Joins, aggregates, sorts and set operations of the inventory that no query above shows by itself.


@query("""SELECT n_name, count(*) AS orders, count(DISTINCT o_custkey) AS customers, CAST(sum(CAST(o_totalprice AS DECIMAL(38,2))) AS DOUBLE) AS total, min(o_orderdate) AS first_at, max(o_orderdate) AS last_at,
  max(o_orderdate) FILTER (WHERE o_orderstatus = 'F') AS last_finished, CAST(coalesce(sum(CASE WHEN o_orderstatus = 'P' THEN 1 END), 0) AS BIGINT) AS pending, count(*) FILTER (WHERE o_orderpriority = '1-URGENT') AS urgent
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY n_name""")
def gauges_by_nation(spark, sf_dir):
    t = lambda x: table(spark, sf_dir, x)
    joined = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(F.broadcast(t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey"))), F.col("c_nationkey") == F.col("n_nationkey"))  # nations and regions are fixed: 25 and 5 rows
    return joined.groupBy("n_name").agg(
        F.count("*").alias("orders"), F.countDistinct("o_custkey").alias("customers"), F.sum(F.col("o_totalprice").cast("decimal(38,2)")).cast("double").alias("total"), F.min("o_orderdate").alias("first_at"), F.max("o_orderdate").alias("last_at"),
        F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))).alias("last_finished"), F.coalesce(F.sum(F.when(F.col("o_orderstatus") == "P", 1)), F.lit(0)).cast("long").alias("pending"), F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )


@query("SELECT c_custkey, c_name, count(o_orderkey) AS orders FROM customer LEFT JOIN orders ON o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '2001-06-01' GROUP BY c_custkey, c_name")
def left_join_counts(spark, sf_dir):
    recent = table(spark, sf_dir, "orders").filter("o_orderdate >= timestamp '2001-06-01'").groupBy("o_custkey").agg(F.count("o_orderkey").alias("n"))
    return table(spark, sf_dir, "customer").join(recent, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "c_name", F.coalesce("n", F.lit(0).cast("long")).alias("orders"))


@query("SELECT user_id, event_type, n FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS rn FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2)) WHERE rn = 1")
def modal_value(spark, sf_dir):
    counts = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    return h.winners(counts, ["user_id"], [F.desc("n"), F.asc("event_type")])


@query("SELECT o_orderkey, o_custkey, o_orderdate FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 10")
def latest_runs(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy(F.desc("o_orderdate"), F.desc("o_orderkey")).limit(10).select("o_orderkey", "o_custkey", "o_orderdate")


@query("SELECT o_custkey AS key FROM orders WHERE year(o_orderdate) = 1995 EXCEPT SELECT o_custkey FROM orders WHERE year(o_orderdate) = 2001")
def set_difference(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.filter("year(o_orderdate) = 1995").select(F.col("o_custkey").alias("key")).subtract(orders.filter("year(o_orderdate) = 2001").select("o_custkey"))


@query("SELECT status, count(*) AS files FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN 'PROCESSED' WHEN o_orderstatus = 'O' THEN 'DISCOVERED' ELSE 'REJECTED' END AS status FROM orders) GROUP BY status")
def files_by_status(spark, sf_dir):
    status = F.when(F.col("o_orderstatus") == "F", "PROCESSED").when(F.col("o_orderstatus") == "O", "DISCOVERED").otherwise("REJECTED")
    return table(spark, sf_dir, "orders").groupBy(status.alias("status")).agg(F.count("*").alias("files"))


@query("SELECT c_custkey AS key, CASE WHEN c_custkey % 3 = 0 THEN 'resident' ELSE 'incoming' END AS origin FROM customer")
def register_unknown(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"))
    resident = customers.filter("key % 3 = 0").withColumn("origin", F.lit("resident"))
    return r.register(resident, customers.unionByName(customers).withColumn("origin", F.lit("incoming")), "key")


# Runs and their ledger: a run for each customer, with a lease from its key.


def _ledger(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    key = F.col("c_custkey")
    pick = lambda *names: F.element_at(F.array(*(F.lit(x) for x in names)), (key % len(names) + 1).cast("int"))
    lease = F.timestamp_seconds(F.unix_timestamp(F.lit("2024-01-01").cast("timestamp")) + (key % 600) - 300)
    made = {
        "run_id": key.cast("long"), "idempotency_key": F.sha2(key.cast("string").cast("binary"), 256), "file_id": (key % 1000).cast("long"), "batch_id": (key % 100).cast("long"),
        "status": pick("PENDING", "RUNNING", "FAILED", "SUCCEEDED", "STAGED"), "lease_expires_at": F.when(key % 5 == 1, lease), "try_number": F.lit(1),
    }
    customers = table(spark, sf_dir, "customer")
    full = lambda df, schema, own: df.select(*(own.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], schema).schema))
    runs = full(customers, m.SCHEMAS["runs"], made)
    stages = full(customers.filter(key % 3 == 0), m.SCHEMAS["stages"], {"run_id": key, "stage_name": F.lit("PUBLISH"), "status": pick("FAILED", "RUNNING", "SUCCEEDED", "PENDING"), "lease_expires_at": lease})
    files = full(spark.range(1000), m.SCHEMAS["files"], {"file_id": F.col("id"), "status": F.lit("DISCOVERED")})
    batches = full(spark.range(100), m.SCHEMAS["batches"], {"batch_id": F.col("id"), "status": F.lit("OPEN")})
    return {"runs": runs, "stages": stages, "files": files, "batches": batches}


LEDGER = """runs AS (SELECT c_custkey AS run_id, c_custkey % 1000 AS file_id, c_custkey % 100 AS batch_id, ['PENDING', 'RUNNING', 'FAILED', 'SUCCEEDED', 'STAGED'][c_custkey % 5 + 1] AS status,
  CASE WHEN c_custkey % 5 = 1 THEN TIMESTAMP '2024-01-01' + INTERVAL (c_custkey % 600 - 300) SECOND END AS lease FROM customer),
stages AS (SELECT c_custkey AS run_id, ['FAILED', 'RUNNING', 'SUCCEEDED', 'PENDING'][c_custkey % 4 + 1] AS status, TIMESTAMP '2024-01-01' + INTERVAL (c_custkey % 600 - 300) SECOND AS lease FROM customer WHERE c_custkey % 3 = 0)"""


def _now() -> Column:
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


@query(f"""WITH {LEDGER}, x AS (SELECT *, run_id % 2 = 0 AND (status IN ('PENDING', 'FAILED') OR (status = 'RUNNING' AND lease < TIMESTAMP '2024-01-01')) AS claimed FROM runs)
SELECT run_id, CASE WHEN claimed THEN 'RUNNING' ELSE status END AS status, CASE WHEN claimed THEN TIMESTAMP '2024-01-01 00:05:00' ELSE lease END AS lease_expires_at, CAST(CASE WHEN claimed THEN 2 ELSE 1 END AS INT) AS try_number, claimed FROM x""")
def run_claims(spark, sf_dir):
    """Every second run is asked for, some of them twice."""
    runs = _ledger(spark, sf_dir)["runs"]
    keys = runs.filter("run_id % 2 = 0").select("idempotency_key")
    wanted = keys.select("idempotency_key", F.lit(2).alias("try_number"), F.lit("w").alias("worker")).unionByName(keys.select("idempotency_key", F.lit(1).alias("try_number"), F.lit("v").alias("worker")))
    return m.claim_runs(runs, wanted, _now()).select("run_id", "status", "lease_expires_at", "try_number", F.col("_claimed").alias("claimed"))


@query(f"""WITH {LEDGER} SELECT run_id, status, CASE WHEN status = 'RUNNING' THEN TIMESTAMP '2024-01-01 00:10:00' ELSE lease END AS lease_expires_at, CASE WHEN status = 'RUNNING' THEN run_id * 2 END AS rows_read FROM runs""")
def run_heartbeats(spark, sf_dir):
    runs = _ledger(spark, sf_dir)["runs"]
    beat = lambda minute, times: runs.select("run_id", F.lit(f"2024-01-01 00:{minute}:00").cast("timestamp").alias("lease_expires_at"), (F.col("run_id") * times).alias("rows_read"), (F.col("run_id") * times).alias("rows_parsed"))
    return m.heartbeats(runs, beat("05", 1).unionByName(beat("10", 2))).select("run_id", "status", "lease_expires_at", "rows_read")


@query(f"""WITH {LEDGER}, w AS (SELECT run_id FROM runs WHERE status = 'STAGED'), x AS (
  SELECT coalesce(s.run_id, w.run_id) AS run_id, s.status, s.lease, w.run_id IS NOT NULL AND (s.run_id IS NULL OR s.status IN ('PENDING', 'FAILED') OR (s.status = 'RUNNING' AND s.lease < TIMESTAMP '2024-01-01')) AS claimed
  FROM stages s FULL OUTER JOIN w ON s.run_id = w.run_id)
SELECT run_id, 'PUBLISH' AS stage_name, CASE WHEN claimed THEN 'RUNNING' ELSE status END AS status, CASE WHEN claimed THEN TIMESTAMP '2024-01-01 00:05:00' ELSE lease END AS lease_expires_at, claimed FROM x""")
def stage_claims(spark, sf_dir):
    """The publication of every run is asked for; only staged ones get it."""
    t = _ledger(spark, sf_dir)
    wanted = t["runs"].select("run_id", F.lit("PUBLISH").alias("stage_name"), F.lit(1).alias("try_number"), F.lit("w").alias("worker"))
    return m.claim_stages(t["stages"], t["runs"], wanted, _now()).select("run_id", "stage_name", "status", "lease_expires_at", F.col("_claimed").alias("claimed"))


@query(f"""WITH {LEDGER}, d AS (SELECT * FROM runs WHERE status = 'STAGED' AND run_id % 7 <> 0)
SELECT 'run' AS kind, run_id AS id, CASE WHEN run_id IN (SELECT run_id FROM d) THEN 'SUCCEEDED' ELSE status END AS status, CASE WHEN run_id IN (SELECT run_id FROM d) THEN run_id * 3 END AS rows_loaded FROM runs
UNION ALL SELECT 'file', range, CASE WHEN range IN (SELECT file_id FROM d) THEN 'PROCESSED' ELSE 'DISCOVERED' END, NULL FROM range(1000)
UNION ALL SELECT 'batch', range, CASE WHEN range IN (SELECT batch_id FROM d) THEN 'PUBLISHED' ELSE 'OPEN' END, NULL FROM range(100)""")
def publication_finalise(spark, sf_dir):
    t = _ledger(spark, sf_dir)
    done = t["runs"].filter("status = 'STAGED' AND run_id % 7 != 0").select("run_id", "file_id", "batch_id", (F.col("run_id") * 3).alias("rows_loaded"), _now().alias("finished_at"), F.lit(5).cast("long").alias("duration_ms"), F.lit("report").alias("report_uri"))
    new = m.finalise(t, done)
    row = lambda name, kind, loaded: new[name].select(F.lit(kind).alias("kind"), F.col(f"{kind}_id").alias("id"), "status", loaded.cast("long").alias("rows_loaded"))
    return row("runs", "run", F.col("rows_loaded")).unionByName(row("files", "file", F.lit(None))).unionByName(row("batches", "batch", F.lit(None)))


@query(f"WITH {LEDGER} SELECT run_id, file_id, batch_id FROM runs WHERE status = 'STAGED' ORDER BY run_id")
def staged_runs(spark, sf_dir):
    return m.staged(_ledger(spark, sf_dir)["runs"]).select("run_id", "file_id", "batch_id")


@query(f"WITH {LEDGER} SELECT file_id, max(run_id) AS run_id FROM runs WHERE status = 'SUCCEEDED' GROUP BY file_id")
def latest_run_per_file(spark, sf_dir):
    return m.latest_succeeded(_ledger(spark, sf_dir)["runs"], "file_id")


@query("SELECT sha256(text) AS content_sha256, max(doc_id) AS run_id FROM documents WHERE doc_id % 5 = 3 GROUP BY text")
def latest_run_per_content(spark, sf_dir):
    """Each document is a file with a run of its own number, of which every fifth succeeded."""
    status = F.when(F.col("file_id") % 5 == 3, "SUCCEEDED").otherwise("FAILED")
    return m.latest_succeeded(_files(spark, sf_dir).withColumn("run_id", F.col("file_id")).withColumn("status", status), "content_sha256")


@query("SELECT count(*) AS receipts, CAST(sum(o_custkey) AS BIGINT) AS rows_read, CAST(sum(o_orderkey) AS BIGINT) AS rows_loaded, CAST(coalesce(sum(CASE WHEN o_orderkey % 9 = 0 THEN 1 END), 0) AS BIGINT) AS rows_rejected FROM orders")
def receipts_sum(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return m.receipts(orders.select(F.col("o_custkey").alias("rows_read"), F.col("o_orderkey").alias("rows_loaded"), F.when(F.col("o_orderkey") % 9 == 0, 1).alias("rows_rejected")))


@query(FINDINGS + " SELECT 1::BIGINT AS run_id, '[' || string_agg('{\"rule_type\":\"' || rule_type || '\",\"outcome\":\"' || outcome || '\",\"evaluated_count\":' || evaluated || ',\"failed_count\":' || failed || '}', ',' ORDER BY rank, rule_type) || ']' AS report FROM (SELECT *, CASE WHEN failed = 0 THEN 'PASS' WHEN strategy = 'WARN_AND_CONTINUE' THEN 'PASS_WITH_WARNING' ELSE 'FAIL' END AS outcome, CASE WHEN failed = 0 THEN 2 WHEN strategy = 'WARN_AND_CONTINUE' THEN 1 ELSE 0 END AS rank FROM f)")
def validation_report(spark, sf_dir):
    found = q.findings(q.judge(dirty_customers(spark, sf_dir), CUSTOMER_RULES, "ordinal"), CUSTOMER_RULES)
    return m.report(found.select(F.lit(1).cast("long").alias("run_id"), "rule_type", F.col("status").alias("outcome"), F.col("evaluated").alias("evaluated_count"), F.col("failed").alias("failed_count")))


def _at(spark: SparkSession, sf_dir: str, name: str) -> str:
    return _written(spark, sf_dir, name, {})


@query(FINDINGS + " SELECT 1::BIGINT AS run_id, rule_type, outcome, evaluated AS evaluated_count, failed AS failed_count FROM (SELECT *, CASE WHEN failed = 0 THEN 'PASS' WHEN strategy = 'WARN_AND_CONTINUE' THEN 'PASS_WITH_WARNING' ELSE 'FAIL' END AS outcome FROM f)")
def findings_recorded(spark, sf_dir):
    """A try that died had recorded other findings for the run; those of the next one stand."""
    ledger = m.RunLedger(spark, _at(spark, sf_dir, "findings"))
    found = q.findings(q.judge(dirty_customers(spark, sf_dir), CUSTOMER_RULES, "ordinal"), CUSTOMER_RULES)
    rows = found.select(F.lit(1).cast("long").alias("run_id"), "rule_type", F.col("status").alias("outcome"), F.col("evaluated").alias("evaluated_count"), F.col("failed").alias("failed_count"))
    ledger.record("findings", rows.withColumn("failed_count", F.col("failed_count") + 1), 1)
    ledger.record("findings", rows, 1)
    return ledger.read("findings").select("run_id", "rule_type", "outcome", "evaluated_count", "failed_count")


@query(f"WITH {DIRTY_CUSTOMERS} SELECT 1::BIGINT AS run_id, ordinal AS source_row_number, coalesce(e1, e2, e4) AS error_type, 'PENDING' AS resolution_type FROM judged WHERE coalesce(e1, e2, e4) IS NOT NULL")
def rejects_recorded(spark, sf_dir):
    ledger = m.RunLedger(spark, _at(spark, sf_dir, "rejects"))
    rejects = q.split(dirty_customers(spark, sf_dir), CUSTOMER_RULES, "ordinal").rejects
    rows = rejects.select(F.lit(1).cast("long").alias("run_id"), F.col("ordinal").cast("long").alias("source_row_number"), "error_type", "error_column", F.lit("PENDING").alias("resolution_type"))
    ledger.record("rejects", rows, 1)
    return ledger.read("rejects").select("run_id", "source_row_number", "error_type", "resolution_type")


@query("""WITH d AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM events WHERE day(ts) % 7 <> 3), s AS (SELECT CAST(unnest(range(min(day), max(day) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM d) SELECT 'events' AS dataset, 'run-' || strftime(day, '%Y-%m-%d') AS dag_run FROM s WHERE day NOT IN (SELECT day FROM d)""")
def gaps_recorded(spark, sf_dir):
    """Once for each run, however often it is told."""
    ledger = m.RunLedger(spark, _at(spark, sf_dir, "gaps"))
    days = table(spark, sf_dir, "events").filter("day(ts) % 7 != 3").select(F.to_date("ts").alias("day"))
    rows = r.gaps(days, "day").select(F.lit("events").alias("dataset"), F.concat(F.lit("run-"), F.col("day").cast("string")).alias("dag_run"), F.lit("b").alias("backfill_id"))
    ledger.record("gaps", rows)
    ledger.record("gaps", rows)
    return ledger.read("gaps").select("dataset", "dag_run")


@query(f"WITH {BRONZE} SELECT o_custkey, o_orderstatus, _source_row_number, _run_id FROM bronze WHERE _run_id <> 3 AND NOT (_run_id = 2 AND _source_row_number % 2 = 0)")
def bronze_reruns(spark, sf_dir):
    """Run 2 is tried again with half of its rows, run 3 with none."""
    at = _at(spark, sf_dir, "bronze")
    rows = bronze_orders(spark, sf_dir).select(F.col("o_custkey").cast("long").alias("o_custkey"), "o_orderstatus", F.col("_source_row_number").cast("long").alias("_source_row_number"), "_run_id")
    bronze = BronzeTable(spark, f"{at}/t", "o_custkey long, o_orderstatus string, _source_row_number long")
    for run in range(9):  # a run per year
        bronze.append(rows.filter(F.col("_run_id") == run), run)
    bronze.append(rows.filter("_run_id = 2 AND _source_row_number % 2 != 0"), 2)
    bronze.append(rows.filter("_run_id < 0"), 3)
    return bronze.read().select("o_custkey", "o_orderstatus", "_source_row_number", "_run_id")


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer WHERE c_custkey % 4 = 0")
def per_run_staging(spark, sf_dir):
    """All text, and of the last try only."""
    bronze = BronzeTable(spark, f"{_at(spark, sf_dir, 'staging')}/t", "id string, name string")
    rows = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"))
    bronze.stage(rows, 1)
    return bronze.stage(rows.filter("id % 4 = 0"), 1)


@query("SELECT 'customers.rows' AS counter, count(*) AS n FROM customer UNION ALL SELECT 'customers.rich', count(*) FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT 'kept.rows', count(*) FROM customer WHERE c_custkey % 2 = 0")
def observed_counters(spark, sf_dir):
    counters = Counters()
    seen = counters.watch(table(spark, sf_dir, "customer"), "customers", rich=F.col("c_acctbal") > 5000)
    counters.watch(seen.filter("c_custkey % 2 = 0"), "kept").write.format("noop").mode("overwrite").save()
    return spark.createDataFrame(list(counters.values().items()), "counter string, n long")


@query("SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN 'RAGGED_ROW' END AS error FROM part")
def structural_rule(spark, sf_dir):
    fields = F.when(F.col("p_partkey") % 6 == 0, F.array("p_name")).otherwise(F.array("p_name", "p_name"))
    rows = table(spark, sf_dir, "part").select("p_partkey", fields.alias("fields"))
    return q.judge(rows, [q.Rule("structural", "fields", options={"width": 2})], "p_partkey").select("p_partkey", F.get("_errors", 0).alias("error"))


BREACH = """WITH f AS (SELECT CAST(o_custkey % 23 AS INT) AS dataset_id, max(o_orderdate - INTERVAL (o_custkey % 23) DAY) AS last_file FROM orders GROUP BY 1),
d AS (SELECT n_nationkey AS dataset_id, n_name AS dataset_name, CAST(epoch(TIMESTAMP '2001-08-02') - epoch(coalesce(last_file, TIMESTAMP '1994-01-01')) AS BIGINT) AS delay,
  CASE WHEN n_nationkey % 3 = 0 THEN 86400 ELSE 0 END AS warn, CASE WHEN n_nationkey % 2 = 0 THEN 259200 END AS fail FROM nation LEFT JOIN f ON f.dataset_id = n_nationkey WHERE n_nationkey % 5 <> 0)"""


@query(BREACH + " SELECT dataset_id, dataset_name, delay FROM d WHERE delay > 86400 + warn")
def freshness_breach_warn(spark, sf_dir):
    datasets, files, _ = _meta(spark, sf_dir)
    return r.freshness_breaches(datasets, files, F.lit("2001-08-02 00:00:00").cast("timestamp"), "warn")


@query(BREACH + " SELECT dataset_id, dataset_name, delay FROM d WHERE delay > 86400 + fail")
def freshness_breach_fail(spark, sf_dir):
    datasets, files, _ = _meta(spark, sf_dir)
    return r.freshness_breaches(datasets, files, F.lit("2001-08-02 00:00:00").cast("timestamp"), "fail")


@query(f"""WITH {RUNS}, x AS (SELECT run_id, CASE WHEN status = 'SUCCEEDED' AND s2 = 'SUCCEEDED' THEN 'complete' WHEN s0 IS NULL OR s0 IN ('FAILED', 'PENDING') THEN 'retry stage STAGE_LOAD'
  WHEN s1 IS NULL OR s1 IN ('FAILED', 'PENDING') THEN 'retry stage DBT_BUILD' WHEN s2 IS NULL OR s2 IN ('FAILED', 'PENDING') THEN 'retry stage PUBLISH' ELSE 'in progress' END AS next_action FROM r)
SELECT * FROM x WHERE next_action LIKE 'retry stage%'""")
def stuck_stages(spark, sf_dir):
    return r.stuck_stages(r.run_recovery(*_runs(spark, sf_dir)))


@query("SELECT o_orderpriority AS dataset, avg(epoch_ms(o_orderdate + INTERVAL (o_orderkey % 500) SECOND) - epoch_ms(o_orderdate)) AS avg_duration_ms, count(*) AS runs FROM orders GROUP BY 1")
def average_duration(spark, sf_dir):
    """Runs last as many seconds as their key says."""
    start = F.col("o_orderdate").cast("timestamp")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("dataset"), start.alias("a"), F.timestamp_seconds(F.unix_timestamp(start) + F.col("o_orderkey") % 500).alias("b"))
    return orders.groupBy("dataset").agg(F.avg(F.unix_millis("b") - F.unix_millis("a")).alias("avg_duration_ms"), F.count("*").alias("runs"))


@query(f"WITH {BRONZE} SELECT o_custkey, _source_row_number, _run_id FROM bronze WHERE _run_id > (SELECT coalesce(max(_run_id), 0) FROM bronze WHERE _run_id <= 5)")
def above_high_water(spark, sf_dir):
    bronze = bronze_orders(spark, sf_dir)
    return h.above(bronze, h.high_water(bronze.filter("_run_id <= 5"))).select("o_custkey", "_source_row_number", "_run_id")


@query("""WITH v AS (SELECT o_custkey, o_orderstatus, o_orderkey % 3 = 0 AS is_current FROM orders)
SELECT 'not_null:o_orderstatus' AS "constraint", count(*) AS violations FROM v WHERE o_orderstatus = 'P' HAVING count(*) > 0
UNION ALL SELECT 'unique_current:o_custkey', count(*) FROM (SELECT o_custkey FROM v WHERE is_current GROUP BY 1 HAVING count(*) > 1) HAVING count(*) > 0""")
def table_constraints(spark, sf_dir):
    versions = table(spark, sf_dir, "orders").select("o_custkey", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"), (F.col("o_orderkey") % 3 == 0).alias("is_current"))
    return q.constraint_violations(versions, ["o_custkey", "o_orderstatus"], ["o_custkey"], "is_current")


@query("""WITH d AS (SELECT source AS dataset_id, doc_id AS file_id, CASE WHEN doc_id % 2 = 0 THEN nullif(min(doc_id) OVER (PARTITION BY source, text), doc_id) END AS old, nullif(min(doc_id) OVER (PARTITION BY source, text), doc_id) AS found FROM documents)
SELECT dataset_id, file_id, coalesce(old, found) AS duplicate_of_file_id, old IS NULL AND found IS NOT NULL AS repaired FROM d""")
def lineage_repair(spark, sf_dir):
    """Only files of even numbers have their pointers yet."""
    files = r.duplicate_files(_files(spark, sf_dir)).withColumn("duplicate_of_file_id", F.when(F.col("file_id") % 2 == 0, F.col("duplicate_of_file_id")))
    return r.repair_lineage(files).select("dataset_id", "file_id", "duplicate_of_file_id", "repaired")


#: Raw texts of customers in their contract: a name, a balance, a day and a flag, some of them broken.
CUSTOMER_CONTRACT = c.DatasetContract(
    "customers",
    (
        c.ColumnContract("id", "integer", nullable=False, business_key=True),
        c.ColumnContract("name", "string"),
        c.ColumnContract("balance", "decimal"),
        c.ColumnContract("day", "date"),
        c.ColumnContract("flag", "boolean", true_tokens=("Y",), false_tokens=("N",)),
    ),
    dedup_keys=("id",),
)
CUSTOMER_CONTRACT = c.with_sentinels(CUSTOMER_CONTRACT, {"balance": ("n/a",)})


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.cast("string").alias("id"), F.when(k % 10 == 0, "").when(k % 10 == 1, F.concat("c_name", F.char(F.lit(0)))).otherwise(F.col("c_name")).alias("name"),
        F.when(k % 7 == 0, "n/a").when(k % 11 == 0, "12.x").otherwise((k * 3).cast("string")).alias("balance"),
        F.when(k % 13 == 0, "2024-02-30").otherwise("2024-02-29").alias("day"), F.when(k % 17 == 0, "maybe").when(k % 2 == 0, "Y").otherwise("N").alias("flag"),
    )


RAW_CUSTOMERS = """x AS (SELECT c_custkey AS id, CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_name END AS name, CASE WHEN c_custkey % 7 <> 0 THEN c_custkey * 3 END AS balance, c_custkey % 2 = 0 AS flag,
  CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 11 = 0 THEN 'balance' WHEN c_custkey % 13 = 0 THEN 'day' WHEN c_custkey % 17 = 0 THEN 'flag' END AS error_column FROM customer)"""


@query(f"WITH {RAW_CUSTOMERS} SELECT CAST(id AS VARCHAR) AS id, name, CAST(balance AS VARCHAR) AS balance, '2024-02-29' AS day, CASE WHEN flag THEN 'True' ELSE 'False' END AS flag FROM x WHERE error_column IS NULL")
def contract_normalised(spark, sf_dir):
    return c.normalised(raw_customers(spark, sf_dir), CUSTOMER_CONTRACT).good


@query(f"""WITH {RAW_CUSTOMERS} SELECT CASE error_column WHEN 'balance' THEN 'invalid-numeric-value' WHEN 'day' THEN 'invalid-calendar-date' ELSE 'unmapped-boolean-token' END AS error_type, error_column,
  concat_ws(',', CAST(id AS VARCHAR), coalesce(name, ''), CASE WHEN id % 7 = 0 THEN 'n/a' WHEN id % 11 = 0 THEN '12.x' ELSE CAST(id * 3 AS VARCHAR) END, CASE WHEN id % 13 = 0 THEN '2024-02-30' ELSE '2024-02-29' END, CASE WHEN id % 17 = 0 THEN 'maybe' WHEN flag THEN 'Y' ELSE 'N' END) AS raw_line
FROM x WHERE error_column IS NOT NULL""")
def contract_rejects(spark, sf_dir):
    return c.normalised(raw_customers(spark, sf_dir), CUSTOMER_CONTRACT).rejects


@query("SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_custkey END AS number, CASE WHEN c_custkey % 9 = 0 THEN 'not-castable-to-integer' END AS error, DATE '2024-02-29' AS day FROM customer")
def cast_at_publish(spark, sf_dir):
    k = F.col("c_custkey")
    cast = n.typed(F.when(k % 9 == 0, "12x").otherwise(k.cast("string")), "integer")
    return table(spark, sf_dir, "customer").select("c_custkey", cast.alias("t"), n.typed(F.lit("2024-02-29"), "date")["value"].alias("day")).select("c_custkey", F.col("t.value").alias("number"), "t.error", "day")


# Sources: files written from whole tables, or made for a case, and read again.


def _written(spark: SparkSession, sf_dir: str, name: str, files: dict[str, bytes]) -> str:
    """Small files made for a query, in the folder that all executors share."""
    import uuid

    at = f"{shared_dir(spark)}/tidemark-{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path
    for file, data in files.items():
        to = path(f"{at}/{file}")
        out = to.getFileSystem(spark._jsc.hadoopConfiguration()).create(to)
        out.write(bytearray(data))
        out.close()
    return at


def _customer_files(spark: SparkSession, sf_dir: str) -> str:
    """A CSV file for each nation: names quoted, with a doubled quote and a line end in some, and a field too many in others."""
    at = f"{_written(spark, sf_dir, 'customers', {})}/files"
    k = F.col("c_custkey")
    name = F.concat(F.lit('"'), "c_name", F.when(k % 5 == 0, '""x').when(k % 5 == 1, "\ny").otherwise(""), F.lit('"'))
    line = F.concat_ws(",", k.cast("string"), name, "c_mktsegment", F.when(k % 19 == 0, "more"))
    rows = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), k.alias("k"), line.alias("value"))
    heads = rows.select("nation").distinct().select("nation", F.lit(-1).cast("long").alias("k"), F.lit("id,name,segment").alias("value"))
    whole = rows.withColumn("k", F.col("k").cast("long")).unionByName(heads).repartition("nation").sortWithinPartitions("nation", "k")
    whole.select("nation", "value").write.partitionBy("nation").text(at)
    return at


CUSTOMER_FILES = """f AS (SELECT c_nationkey AS nation, c_custkey AS k, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS ordinal,
  c_name || CASE c_custkey % 5 WHEN 0 THEN '""x' WHEN 1 THEN chr(10) || 'y' ELSE '' END AS quoted, c_name || CASE c_custkey % 5 WHEN 0 THEN '"x' WHEN 1 THEN chr(10) || 'y' ELSE '' END AS name, c_mktsegment AS segment FROM customer)"""


def _nation(path: str = "path") -> Column:
    return F.regexp_extract(path, "nation=([0-9]+)", 1).cast("int").alias("nation")


@query(f"WITH {CUSTOMER_FILES} SELECT CAST(nation AS INT) AS nation, ordinal, CAST(k AS VARCHAR) AS id, name, segment, CASE WHEN k % 19 = 0 THEN 'RAGGED_ROW' END AS error FROM f")
def csv_scan_customers(spark, sf_dir):
    found = scan(spark, _customer_files(spark, sf_dir) + "/nation=*").filter("ordinal > 0")
    return found.select(_nation(), "ordinal", *(F.get("fields", i).alias(x) for i, x in enumerate(("id", "name", "segment"))), "error")


@query(f"WITH {CUSTOMER_FILES} SELECT CAST(nation AS INT) AS nation, ordinal, CAST(k AS VARCHAR) AS id FROM f WHERE ordinal >= 3")
def csv_scan_resumed(spark, sf_dir):
    found = resume(scan(spark, _customer_files(spark, sf_dir) + "/nation=*"), 3)
    return found.select(_nation(), "ordinal", F.get("fields", 0).alias("id"))


@query(f"""WITH {CUSTOMER_FILES}, t AS (SELECT nation, 'id,name,segment' || chr(10) || string_agg(concat_ws(',', CAST(k AS VARCHAR), '"' || quoted || '"', segment, CASE WHEN k % 19 = 0 THEN 'more' END) || chr(10), '' ORDER BY k) AS body FROM f GROUP BY nation)
SELECT CAST(nation AS INT) AS nation, strlen(body) AS length, sha256(body) AS content_sha256, 'REJECTED' AS status, 'unsupported-extension' AS reason FROM t""")
def file_listing(spark, sf_dir):
    """Spark's text files have no extension that the gate knows, so it turns them away, but they are listed and hashed."""
    listed = discover.integrity(discover.list_files(spark, _customer_files(spark, sf_dir), glob="part-*", content=True))
    return listed.select(_nation(), "length", "content_sha256", "status", "reason")


@query("""SELECT * FROM (VALUES ('a.csv', 4, 'ACCEPTED', NULL), ('b.csv.gz', 4, 'ACCEPTED', NULL), ('c.txt', 4, 'REJECTED', 'unsupported-extension'), ('d.csv', 0, 'REJECTED', 'empty-file'), ('E.CSV.ZIP', 2, 'ACCEPTED', NULL)) t(name, length, status, reason)""")
def integrity_gate(spark, sf_dir):
    at = _written(spark, sf_dir, "gate", {"a.csv": b"id\n1", "b.csv.gz": b"id\n1", "c.txt": b"id\n1", "d.csv": b"", "E.CSV.ZIP": b"id"})
    return discover.integrity(discover.list_files(spark, at)).select("name", F.col("length").cast("int").alias("length"), "status", "reason")


@query("SELECT doc_id AS file_id FROM documents QUALIFY min(doc_id) OVER (PARTITION BY source, text) = doc_id ORDER BY 'docs/' || lpad(CAST(doc_id AS VARCHAR), 12, '0') LIMIT 100")
def units_cap(spark, sf_dir):
    """The manifest of a run takes the first hundred new files in order of their path."""
    path = F.concat(F.lit("docs/"), F.lpad(F.col("file_id").cast("string"), 12, "0"))
    files = _files(spark, sf_dir).withColumn("path", path).withColumn("status", F.lit("ACCEPTED"))
    return discover.candidates(files, files.filter("false"), 100).select("file_id")


@query("SELECT doc_id, CAST(7 AS BIGINT) AS expected_row_count FROM documents")
def marker_gate(spark, sf_dir):
    """A listing shows with its marker's totals, and not at all without, or with an invalid one."""
    listing = table(spark, sf_dir, "documents").select("doc_id", F.col("doc_id").cast("string").alias("name"))
    marks = spark.createDataFrame([("done.json", '{"expected_row_count": 7}'), ("bad.json", '{"expected_row_count": -1}')], "name string, text string")
    shown = [discover.marked(listing, marks, x).select("doc_id", "expected_row_count") for x in ("done.json", "bad.json", "none.json")]
    return shown[0].unionByName(shown[1]).unionByName(shown[2])


@query("""SELECT * FROM (VALUES ('header', 1, NULL), ('name', NULL, 'id'), ('name', NULL, 'full name'), ('repeated', 4, NULL), ('footer', 6, NULL), ('footer', 7, NULL), ('duplicate', NULL, 'duplicate-header-names: id')) t(what, place, text)""")
def header_footer(spark, sf_dir):
    """What detection tells of a file with a preamble, a repeated header and a footer; and of names that differ in case only."""
    rows = [["report"], [" id", "full name "], ["1", "a"], ["2", "b"], [" id", "full name "], ["3", "c"], ["Total", "3"], ["end"]]
    found = detect.detect_header(rows, footer_patterns=["Total"])
    out = [("header", found.index, None), *(("name", None, x) for x in found.names), *(("repeated", x, None) for x in found.repeated), *(("footer", x, None) for x in found.footer)]
    try:
        detect.detect_header([["Id", "ID"], ["1", "2"]])
    except detect.SourceError as e:
        out.append(("duplicate", None, str(e)))
    return spark.createDataFrame(out, "what string, place int, text string")


@query("""SELECT * FROM (VALUES ('c_custkey', 'integer', TRUE, TRUE), ('c_name', 'string', TRUE, TRUE), ('c_acctbal', 'decimal', TRUE, TRUE)) t(name, type, nullable, required)""")
def suggested_schema(spark, sf_dir):
    texts = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("c_custkey"), "c_name", F.col("c_acctbal").cast(MONEY).cast("string").alias("c_acctbal"))
    return detect.suggest_schema(detect.infer_types(texts, texts.columns))


@query("SELECT c_custkey, 'a' || c_name AS text, c_custkey || ',' || c_name || ',,True' AS raw_line FROM customer")
def raw_lines(spark, sf_dir):
    dirty = F.concat(F.lit("a"), F.char(F.lit(0)), "c_name")
    return table(spark, sf_dir, "customer").select("c_custkey", n.strip_nul(dirty).alias("text"), n.raw_line(F.col("c_custkey"), F.col("c_name"), F.lit(None).cast("string"), n.field_text(F.lit(True), "boolean")).alias("raw_line"))


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'x' END AS extra_dropped, p_name AS name FROM part WHERE FALSE UNION ALL SELECT p_partkey, NULL, p_name FROM part")
def width_truncation(spark, sf_dir):
    """Fields beyond the contract's columns are cut."""
    made = table(spark, sf_dir, "part").select(F.lit("f").alias("path"), F.col("p_partkey").cast("long").alias("ordinal"), F.array(F.col("p_partkey").cast("string"), "p_name", F.lit("surplus")).alias("fields"), F.lit(None).cast("string").alias("error"))
    cut = as_columns(made.withColumn("ordinal", F.col("ordinal") + 1), ["p_partkey", "name"])
    return cut.select(F.col("p_partkey").cast("long").alias("p_partkey"), F.lit(None).cast("string").alias("extra_dropped"), "name")


@query("SELECT CAST(o_custkey AS BIGINT) AS k, CAST(count(*) AS BIGINT) AS n FROM orders GROUP BY 1 HAVING FALSE UNION ALL SELECT -1, 0")
def typed_empty_relation(spark, sf_dir):
    """A table before its first publication has its schema and no rows."""
    at = _written(spark, sf_dir, "empty", {})
    none = VersionedTable(spark, f"{at}/t", "k long, n long").read()
    return none.unionByName(none.agg(F.lit(-1).cast("long").alias("k"), F.count("*").alias("n")))


@query("""SELECT * FROM (VALUES ('a.csv', 1, '["1","x"]', NULL), ('a.csv', 2, '["2","two\\nlines"]', NULL), ('a.csv', 3, '["3","y"]', NULL), ('a.csv', 4, '["4"]', 'RAGGED_ROW')) t(file, ordinal, fields, error)""")
def multipart_concatenation(spark, sf_dir):
    """A quoted field begins in one part and ends in the next."""
    at = _written(spark, sf_dir, "parts", {"a.csv": b'id,name\n1,x\n2,"two\n', "b.csv": b'lines"\n3,y\n', "c.csv": b"4\n"})
    found = concatenated(spark, [f"{at}/{x}.csv" for x in "abc"], CsvOptions(delimiter=","))
    return _shown(found).filter("ordinal > 0")


def _shown(found: DataFrame) -> DataFrame:
    return found.select(F.element_at(F.split("path", "/"), -1).alias("file"), F.col("ordinal").cast("int").alias("ordinal"), F.to_json("fields").alias("fields"), F.substring_index("error", ":", 1).alias("error"))


@query("""SELECT * FROM (VALUES ('comma.csv', 0, '["id","name"]', NULL), ('comma.csv', 1, '["1","a"]', NULL), ('comma.csv', 2, '["2","b,\\n\\"c\\""]', NULL), ('comma.csv', 3, '[]', 'RAGGED_ROW'), ('comma.csv', 4, '["3"]', 'RAGGED_ROW'), ('comma.csv', 5, '["4","d","e"]', 'RAGGED_ROW'),
  ('semicolon.csv', 0, '["id","name"]', NULL), ('semicolon.csv', 1, '["1","zażółć"]', NULL), ('semicolon.csv', 2, '["2","x"]', NULL), ('wide.csv', 0, '["id","name"]', NULL), ('wide.csv', 1, '["1","ü"]', NULL),
  ('preamble.csv', 0, '["id","name"]', NULL), ('preamble.csv', 1, '["7","z"]', NULL), ('preamble.csv', 2, '["8","y"]', NULL), ('preamble.csv', 3, '["9","x"]', NULL), ('unclear.csv', -1, '[]', 'undetermined-encoding'),
  ('quotes.csv', 0, '["id","name"]', NULL), ('quotes.csv', 1, '["1","a,b"]', NULL), ('quotes.csv', 2, '["2","c"]', NULL)) t(file, ordinal, fields, error)""")
def csv_scan_messy(spark, sf_dir):
    files = {
        "comma.csv": b"\xef\xbb\xbfid,name\n1,a\n2,\"b,\n\"\"c\"\"\"\n\n3\n4,d,e\n",
        "semicolon.csv": "id;name\r\n1;zażółć\r\n2;x\r\n".encode("cp1250"),
        "wide.csv": "id\tname\n1\tü\n".encode("utf-16"),
        "preamble.csv": b"report\ncreated,2024\nid,name\n7,z\n8,y\n9,x\n",
        "unclear.csv": "id,name\n1,España año\n".encode("cp1252"),
        "quotes.csv": b"id,name\n1,'a,b'\n2,'c'\n",
    }
    return _shown(scan(spark, _written(spark, sf_dir, "messy", files)))


@query("""SELECT * FROM (VALUES ('a.csv.gz', 0, '["id","name"]', NULL), ('a.csv.gz', 1, '["1","x"]', NULL), ('a.csv.gz', 2, '["2","y"]', NULL), ('b.csv.zip', 0, '["id","name"]', NULL), ('b.csv.zip', 1, '["1","q"]', NULL),
  ('two.csv.zip', -1, '[]', 'archive-member-count'), ('bad.csv.gz', -1, '[]', 'corrupted-archive')) t(file, ordinal, fields, error)""")
def gzip_zip_scan(spark, sf_dir):
    import gzip
    import io
    import zipfile

    zipped, two = io.BytesIO(), io.BytesIO()
    with zipfile.ZipFile(zipped, "w") as z:
        z.writestr("a.csv", "id,name\n1,q\n")
    with zipfile.ZipFile(two, "w") as z:
        z.writestr("a.csv", "id\n")
        z.writestr("b.csv", "id\n")
    files = {"a.csv.gz": gzip.compress(b"id,name\n1,x\n2,y\n"), "b.csv.zip": zipped.getvalue(), "two.csv.zip": two.getvalue(), "bad.csv.gz": b"\x1f\x8bnot"}
    return _shown(scan(spark, _written(spark, sf_dir, "packed", files)))


@query()
def stream_available_now(spark, sf_dir):
    """Events as a file stream into a deduplicated table; the same rows whether they come in one batch or several."""
    from .streaming.micro_batch import run_available

    at = _written(spark, sf_dir, "stream", {})
    events = spark.readStream.schema(table(spark, sf_dir, "events").schema).parquet(f"{sf_dir}/events.parquet*")
    target = run_available(spark, events, at, ["user_id"], ("ts", "event_id"))
    return target.select("user_id", "event_id", "ts", "event_type")


@query(ORACLES["upsert_hash_guarded"])
def publisher_dispatch(spark, sf_dir):
    """The upsert, found by the name of its strategy."""
    from .plans.ingest import resolve_publisher

    bronze = bronze_orders(spark, sf_dir)
    resident = h.winners(bronze.filter("_run_id <= 4"), ["o_custkey"], h.newest_first("event_ts", "_source_row_number"))
    made = resolve_publisher("upsert")(resident, bronze.filter("_run_id > 4"), "o_custkey", "event_ts", ties=("_source_row_number",))
    return made.select("o_custkey", "o_orderstatus", "event_ts", "_action")


ORACLES["stream_available_now"] = "SELECT user_id, event_id, ts, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"
