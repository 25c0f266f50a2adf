import random
import zlib

from tidemark.llm.queries import op9_histogram_sort
from tidemark.llm.sharding import shard_by_bytes


def check(rows, data, shards):
    assert sorted(((r.doc_id, r.text) for r in rows), key=str) == sorted(((i, t) for i, t in data), key=str)
    size = lambda t: len((t or "").encode()) + 1
    total, load = sum(size(t) for _, t in data), [0] * shards
    for s in range(shards):
        own = [r for r in rows if r.shard == s]
        assert sorted(r.slot for r in own) == list(range(len(own)))
        load[s] = sum(size(r.text) for r in own)
    assert max(abs(x - total / shards) for x in load) <= max(size(t) for _, t in data) + 1e-4 * total / shards


def test_shards(spark):
    r = random.Random(2)
    data = [(i, r.choice(["é", "ab "]) * r.randint(0, 300)) for i in range(700)] + [(900 + i, "copy") for i in range(300)] + [(None, f"n{i}") for i in range(200)] + [(5, None), (6, None)]
    docs = spark.createDataFrame([(t, i, 1, "s") for i, t in data], "text string, doc_id long, slot int, source string")
    for shards in (8, 3, 1):
        got = shard_by_bytes(spark, docs.repartition(5), shards)
        assert set(got.columns) == {"text", "doc_id", "slot", "source", "shard"}
        check(got.collect(), data, shards)
    one = {(r.doc_id, r.text): (r.shard, r.slot) for r in shard_by_bytes(spark, docs.repartition(5)).collect()}
    assert one == {(r.doc_id, r.text): (r.shard, r.slot) for r in shard_by_bytes(spark, docs.repartition(2)).collect()}


def test_groups_lie_together_in_ranges_of_bounded_bytes(spark):
    r = random.Random(4)
    data = [(i, f"text {i % 150} " * r.randint(1, 1) * 20) for i in range(900)] + [(2000 + i, "a third of all rows " * 12) for i in range(450)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    for range_bytes in (2_000, 1 << 27):
        rows = shard_by_bytes(spark, docs, 8, range_bytes=range_bytes).collect()
        check(rows, data, 8)
        shards = {}
        for x in rows:
            shards.setdefault(x.text, set()).add(x.shard)
        assert all(max(s) - min(s) + 1 == len(s) for s in shards.values())
        assert sum(len(s) > 1 for s in shards.values()) <= 7


def test_repeated_rows_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "x")] * 20 + [(2, "y")], "doc_id long, text string")
    rows = shard_by_bytes(spark, docs).collect()
    assert len(rows) == 21 and len({r.shard for r in rows if r.doc_id == 1}) == 1
    assert shard_by_bytes(spark, spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_query_columns(spark):
    got = op9_histogram_sort(spark, "/root/testdata/sf0.001")
    assert got.columns == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    rows = got.collect()
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id].encode()) + 1 for r in rows)
