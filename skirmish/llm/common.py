"""What the operators share: reading tables, cutting lineage through the shared folder, small expressions."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skirmish.shipping import ship

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def prepare(spark: SparkSession, rows: int = 1000) -> None:
    """Send this package to the executors and keep Arrow batches of whole texts small; a batch size that the user
    changed stays."""
    ship(spark)
    if int(spark.conf.get(ARROW_ROWS)) == 10_000:
        spark.conf.set(ARROW_ROWS, str(rows))


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a local one of our own only where that is unset and executors are
    threads of this process (tests). A cluster without a shared folder is an error."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not shared:
        if not re.fullmatch(r"local(\[[0-9*, ]+\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="skirmish-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return shared.rstrip("/")


def cut(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: lineage ends there, and a lost executor costs
    no more than its running tasks. The folder goes when the application ends."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/skirmish-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    jvm = spark.sparkContext._jvm
    hadoop = jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return spark.read.schema(df.schema).parquet(path)


def drop_cut(df: DataFrame) -> None:
    """Delete a table that cut() wrote, once nothing reads it any more."""
    spark = df.sparkSession
    for path in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, whatever is in their names: dots and backquotes too."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def text_hash() -> list[Column]:
    """Two 64-bit hashes of the text; null has hashes too."""
    text = F.col("text").cast("string")
    return [F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2")]


def crc_mod5(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty text, remainder 0."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % 5
