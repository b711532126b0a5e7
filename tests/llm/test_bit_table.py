"""Bit tables of hashed keys."""

from pyspark.sql import functions as F

from echofield.llm import common


def test_table_of_hashes_holds_its_keys_and_hashes_none_again(spark):
    rows = spark.range(2000).select(F.xxhash64("id").alias("t"), "id")
    for hashed in (False, True):
        table = common.bit_table(rows.filter("id < 300"), ["t"], 14, hashed=hashed)
        out = rows.withColumn("_table", table.scalar()).select("id", common.in_table(F.col("_table"), ["t"], 14, hashed=hashed).alias("in")).collect()
        assert all(r["in"] for r in out if r.id < 300) and sum(r["in"] for r in out if r.id >= 300) < 100
        assert len({r.id for r in out}) == 2000
    assert "xxhash64" not in str(common.in_table(F.col("_table"), ["t"], 14, hashed=True))
