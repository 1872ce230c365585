"""Published stages and mergeable statistics."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tradewind.operators import aggregates as agg
from tradewind.sources import stages


def test_a_write_that_dies_leaves_the_former_version(spark, tmp_path):
    root = str(tmp_path)
    first = stages.write_stage(spark.range(5), root, "V1", "S")
    dies = spark.range(100).withColumn("x", F.when(F.col("id") == 99, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        stages.write_stage(dies.select("id", "x"), root, "V1", "S")
    assert stages.read_stage(spark, root, "V1", "S").count() == 5
    assert stages.write_stage(spark.range(7), root, "V1", "S") != first
    stages.write_stage(spark.range(9), root, "V2", "S")
    assert stages.read_stage(spark, root, "V1", "S").count() == 7 and stages.read_stage(spark, root, "V2", "S", ["id"]).count() == 9
    assert spark.read.parquet(first).count() == 5 and stages.stage_versions(spark, root, "S").count() == 3  # former files stay
    with pytest.raises(FileNotFoundError):
        stages.read_stage(spark, root, "V3", "S")


def test_a_version_may_be_replaced_from_itself(spark, tmp_path):
    root = str(tmp_path)
    stages.write_stage(spark.range(5), root, "V1", "S")
    stages.write_stage(stages.read_stage(spark, root, "V1", "S").where("id > 1"), root, "V1", "S")
    assert sorted(r.id for r in stages.read_stage(spark, root, "V1", "S").collect()) == [2, 3, 4]


def test_sketches_add_up(spark):
    rows = spark.range(60_000).selectExpr("cast(id % 7001 as string) customer_num", "cast(id % 90 as string) srp_2_desc", "id")
    rows = rows.union(spark.sql("select cast(null as string), cast(null as string), -1L"))
    runs = agg.dataset_sketches(rows.where("id % 3 = 0"), "a").union(agg.dataset_sketches(rows.where("id % 3 <> 0"), "a")).union(agg.dataset_sketches(rows.limit(0), "a"))
    exact, near = agg.dataset_stats(rows, "a").first(), agg.sketched_stats(agg.merge_sketches(runs)).first()
    assert near.n_rows == exact.n_rows
    for c in agg.SKETCHED:
        assert abs(near[c] - exact[c]) <= agg.SKETCH_ERROR * exact[c]
