"""What the operators of this subpackage share: tables, the shared folder, columns."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: the longest run of characters that are neither a space nor one of the controls 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, seen by the driver and all executors.

    Where it is unset, a session within one machine gets a folder of its own; a cluster is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(tempfile.mkdtemp(prefix="gridspark-"))
    return context.getCheckpointDir().rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: computed once, safe from lost executors."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/gridspark-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def words_in(text: Column) -> Column:
    """The number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_text(doc_id: Column) -> Column:
    """The id as text, empty for null."""
    return F.coalesce(doc_id.cast("string"), F.lit(""))


def crc_of_id(doc_id: Column) -> Column:
    return F.crc32(id_text(doc_id).cast("binary"))
