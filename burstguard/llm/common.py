"""Helpers shared by the corpus operators: reading tables, written intermediate tables, let-binding."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts: space and the code points 9 to 13.
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; a folder of our own only in local mode where none is named, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="burstguard-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """``df`` as a table in the shared folder: what follows starts from it, also after an executor is lost.

    The shuffle files that led to it are of no more use. Spark deletes them when the driver's garbage is collected, so
    that is asked for; else the disks of a long job fill with them.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    spark.sparkContext._jvm.System.gc()
    table = spark.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``written`` that nothing will read any more."""
    for table in tables:
        jvm = table.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(table.written_path)
        path.getFileSystem(table.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, however often and in whatever lambda it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def row_key() -> Column:
    """Names a row by its id and text; repeated rows share it."""
    marked = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("n")), F.coalesce("text", F.lit("n")))
    return F.unhex(F.md5(F.concat(F.when(F.col("text").isNull(), "n").otherwise("t"), marked)))
