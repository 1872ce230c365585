"""Stage tables: versioned parquet directories, CSV extracts and the run-statistics table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or what the caller set on the context.

    The caller names it; there is no default, as a folder of one machine is lost with it."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """A new directory name under the shared folder."""
    return f"{checkpoint_folder(spark)}/stage-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` saved to the shared folder with its partitioning, its lineage cut."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def scan_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read a raw extract as text; types are applied later by ``cast_schema``."""
    as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    return (
        spark.read.schema(as_text)
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .csv(path)
    )


def scan_parquet(spark: SparkSession, path: str, cols: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*cols) if cols else df


def write_stage(df: DataFrame, root: str, version: str, stage: str) -> str:
    """Write a stage and publish it: the folder of its files.

    Files go to a new folder; a row of the stage's manifest, appended after they are all there, makes them the newest of
    ``version``. A write that dies midway leaves no row, so readers keep the former files, which are never overwritten."""
    files = f"files-{uuid.uuid4().hex}"
    df.write.parquet(f"{root}/{stage}/{files}")
    row = df.sparkSession.createDataFrame([(version, files)], "version string, files string")
    row.coalesce(1).withColumn("published", F.current_timestamp()).write.mode("append").parquet(f"{root}/{stage}/manifest")
    return f"{root}/{stage}/{files}"


def stage_versions(spark: SparkSession, root: str, stage: str) -> DataFrame:
    """``[version, files, published]``: a row for every complete write of a stage."""
    return spark.read.schema("version string, files string, published timestamp").parquet(f"{root}/{stage}/manifest")


def read_stage(spark: SparkSession, root: str, version: str, stage: str, cols: list[str] | None = None) -> DataFrame:
    """What was published last as ``version`` of a stage."""
    own = stage_versions(spark, root, stage).where(F.col("version") == version)
    newest = own.orderBy(F.desc("published"), F.desc("files")).first()
    if newest is None:
        raise FileNotFoundError(f"{stage} has no version {version}")
    return scan_parquet(spark, f"{root}/{stage}/{newest.files}", cols)


#: Rows of a file of a partitioned matrix, about.
ROWS_PER_FILE = 2_000_000


def write_partitioned_matrix(df: DataFrame, path: str, by: str = "cluster") -> str:
    """One directory per cluster, in files of about ``ROWS_PER_FILE`` rows.

    Rows are dealt by cluster and salt; a cluster has as many salts as its count asks for, so a large one is
    written by many tasks and a small one to a single file."""
    counts = df.groupBy(by).agg(F.ceil(F.count(F.lit(1)) / ROWS_PER_FILE).cast("int").alias("_salts"))
    salted = df.join(counts, by).withColumn("_salt", F.floor(F.rand(1) * F.col("_salts")))
    salted.repartition(by, "_salt").drop("_salt", "_salts").write.mode("overwrite").partitionBy(by).parquet(path)
    return path


def scan_matrix(spark: SparkSession, path: str, cluster: int | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.where(F.col("cluster") == cluster) if cluster is not None else df


def merge_stats(old: DataFrame, new: DataFrame) -> DataFrame:
    """``[name, metric, value]`` of two runs, the newer value winning where both have one."""
    runs = old.select("*", F.lit(0).alias("run")).unionByName(new.select("*", F.lit(1).alias("run")))
    return runs.groupBy("name", "metric").agg(F.max_by("value", "run").alias("value"))


def materialize(df: DataFrame) -> DataFrame:
    """Write an intermediate result once to the shared folder and read it back.

    For results that several later steps read: they then scan only the columns they need, and a
    lost executor costs a re-read and not a recomputation."""
    spark = df.sparkSession
    path = shared_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
