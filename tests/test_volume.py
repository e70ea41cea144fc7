"""How many rows and bytes registered queries deal between tasks, and write, for each line of the test tables."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def moved(spark, what="Records"):
    """Rows, or Bytes, shuffled and written by all stages so far."""
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(jvm.java.util.ArrayList(), False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(getattr(stages.apply(i), f"shuffleWrite{what}")() + getattr(stages.apply(i), f"output{what}")() for i in range(stages.size()))


@pytest.mark.parametrize("name, most", [
    ("e03_connection_roi", 6), ("g01_links_sorted_by_body", 3.5), ("h12_pruned_connection_synapses", 6.5), ("e14_feature_vectors_topx", 5),
    ("j04_line_graphs", 4), ("j05_centroids_and_skeletons", 6), ("j07_line_graphs_of_a_region", 4), ("j04_line_graphs_with_cable", 11),
    ("h06_points_to_regions", 10),
    ("c04_connections_csv", 6),
    ("a16_edit_documents", 11),
    ("k15_merged_bodies", 7),
    ("k08_regions_added_and_removed", 11),
    ("k05_bodies_deleted_and_added", 8.7),
    ("k21_stamps_of_edits", 24),
])
def test_rows_for_each_line(spark, name, most):
    """With tables that are too large to be sent to every task."""
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        before = moved(spark)
        entry.queries()[name](spark, SF).write.format("noop").mode("overwrite").save()
        assert (moved(spark) - before) / lines < most
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_bytes_for_each_line(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet").count()
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        before = moved(spark, "Bytes")
        entry.queries()["a16_edit_documents"](spark, SF).write.format("noop").mode("overwrite").save()
        assert (moved(spark, "Bytes") - before) / lines < 240
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
