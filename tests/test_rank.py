"""Row numbers over several range partitions."""

import pytest

from axonweave.operators import rank as R


@pytest.mark.parametrize("coalesce, advisory", [("true", "64k"), ("true", "1m"), ("false", "64k")])
def test_numbered_over_partitions(spark, coalesce, advisory):
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": coalesce, "spark.sql.adaptive.advisoryPartitionSizeInBytes": advisory, "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    was = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(0, 200_000, 1, 6).selectExpr("id", "pmod(hash(id), 50000) AS x", "pmod(id * 7919, 200000) AS y", "concat('t', id % 3) AS type")
        rows = R.numbered(df, ["x", "y", "type"], 1000, "new_id").collect()
    finally:
        for k, v in was.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    rows.sort(key=lambda r: r.new_id)
    assert [r.new_id for r in rows] == list(range(1000, 201_000))
    assert [(r.x, r.y, r.type) for r in rows] == sorted((r.x, r.y, r.type) for r in rows)
