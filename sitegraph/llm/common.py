"""Session helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the contracts: blank and the control characters 9 to 13.
BLANKS = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under the one that the cluster names in spark.checkpoint.dir.

    Where the session names none, a temporary folder is set if the session is one process; on a
    cluster that is an error, as executors would not see each other's files.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("name a folder that all executors see in spark.checkpoint.dir")
        base = tempfile.mkdtemp(prefix="sitegraph-")
        sc.setCheckpointDir(base)
        base = f"file://{base}"
    return f"{base.rstrip('/')}/sitegraph-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df to the shared folder, return what is read back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: Column | str, modulus: int) -> Column:
    """crc32 of the id written as text, modulo; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % F.lit(modulus)


def only(df: DataFrame, *names: str) -> DataFrame:
    """The named columns and no others, so that no extra column can clash with a result's."""
    return df.select(*[F.col(f"`{n}`") for n in names])
