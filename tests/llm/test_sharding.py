import zlib

import duckdb
from pyspark.sql import functions as F

from tests.llm.helpers import documents, edge_rows
from vocalis.llm import sharding
from vocalis.llm.registry import ORACLES, QUERIES


def check(rows, n):
    """rows: (shard, slot, size), any order."""
    total = sum(s for _, _, s in rows)
    by = {}
    for shard, slot, size in rows:
        by.setdefault(shard, []).append((slot, size))
    for its in by.values():
        assert sorted(x for x, _ in its) == list(range(len(its)))
    most = max((s for _, _, s in rows), default=0)
    for k in range(n):
        assert abs(sum(s for _, s in by.get(k, [])) - total / n) <= most + 1


def test_query(spark):
    sf = "/root/testdata/sf0.1"
    out = QUERIES["op7_sharding"](spark, sf).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    assert len(out) == len(texts)
    for r in out:
        raw = texts[r["doc_id"]].encode()
        assert r["size"] == len(raw) + 16 and r["text_crc32"] == zlib.crc32(raw)
    check([(r["shard"], r["slot"], r["size"]) for r in out], 40)
    assert {r["shard"] for r in out} == set(range(40))
    order = sorted(out, key=lambda r: r["doc_id"])
    assert [r["shard"] for r in order] == sorted(r["shard"] for r in out)  # contiguous


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql("create view documents as select * from '/root/testdata/sf0.001/documents.parquet'")
    cols = "doc_id, size, text_crc32, law, shard, slot, grown_shard"
    want = con.sql(f"select {cols} from ({ORACLES['op7_sharding']})").fetchall()
    got = QUERIES["op7_sharding"](spark, "/root/testdata/sf0.001").select(*cols.split(", ")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_edges(spark):
    docs = documents(spark, edge_rows() * 3).withColumn("size", F.octet_length("text").cast("long")).drop("text")
    docs = docs.withColumn("shard", F.lit("clash"))
    out = sharding.byte_shards(docs, ["doc_id", "size"], n_shards=4)
    assert "source" in out.columns
    rows = out.collect()
    assert len(rows) == docs.count()
    check([(r["shard"], r["slot"], r["size"] or 0) for r in rows], 4)
    assert sharding.byte_shards(docs.limit(0), ["doc_id"]).count() == 0
    zero = docs.withColumn("size", F.lit(None).cast("long"))
    assert {r["shard"] for r in sharding.byte_shards(zero, ["doc_id"]).collect()} == {0}
    ties = spark.range(500).select(F.lit(1).alias("doc_id"), F.lit(7).cast("long").alias("size"))
    check([(r["shard"], r["slot"], 7) for r in sharding.byte_shards(ties, ["doc_id"], n_shards=8).collect()], 8)
