"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rule `[^\x20\x09-\x0D]+`, as a Java pattern.
SPACE = r"[\x20\x09-\x0D]+"
_LOCAL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(name: str, columns: list[str]) -> str:
    """A column name that isn't among these."""
    while name in columns:
        name += "_"
    return name


def let(value: Column, body) -> Column:
    """body(value), with value computed once for a row however often body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text in order; none for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir of the session, which must be set on a cluster.

    Where it is unset and everything runs in one process (tests), a temporary folder serves.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return _LOCAL.setdefault(context.applicationId, tempfile.mkdtemp(prefix="spark-shared-"))


def written(df: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder, so that lineage ends, a lost executor costs no recomputation, later steps read
    the columns that they need, and planning starts from the table's real size."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(*tables: DataFrame) -> None:
    """Deletes the files of written tables that nothing reads any more."""
    for df in tables:
        for folder in {name.rpartition("/")[0] for name in df.inputFiles()}:
            path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
