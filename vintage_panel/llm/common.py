"""What the document operators share: words, folded letters, stored intermediate tables."""

from __future__ import annotations

import string
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# fixed values: the white space that parts words
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; every other letter stays."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """Maximal runs of characters other than white space; none for NULL."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE_RUN)
    return F.filter(parts, lambda w: w != "")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which all executors reach.

    Only a local master may leave it unset; then this sets one for the session.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="llm-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", named)
    return named.rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written below the shared folder and read back.

    A lost executor then rereads files instead of repeating all that came before.  The
    files go when the session ends.
    """
    spark = df.sparkSession
    target = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(target)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(target)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(target)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
