"""Catalogues of published files as tables: files (file_id, name, created_at) and documents that describe them (doc_id, file_id, ...)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import PanelError

RECORD = T.StructType(
    [
        T.StructField("loa", T.StringType(), False),
        T.StructField("name", T.StringType(), False),
        T.StructField("type", T.StringType(), False),
        T.StructField("targets", T.ArrayType(T.StringType(), False), False),
        T.StructField("category", T.StringType(), False),
        T.StructField("description", T.StringType(), True),
        T.StructField("file_hash", T.StringType(), True),
        T.StructField("file_id", T.StringType(), True),
        T.StructField("created_at", T.TimestampType(), True),
    ]
)
CATEGORIES = ("historical", "forecast")


def find(records: DataFrame, equal: dict | None = None, holding: dict | None = None) -> DataFrame:
    """Records whose columns equal these values and whose array columns hold these."""
    for c, v in (equal or {}).items():
        records = records.where(F.col(c) == F.lit(v))
    for c, v in (holding or {}).items():
        for x in v if isinstance(v, (list, tuple)) else [v]:
            records = records.where(F.array_contains(c, x))
    return records


def newest(records: DataFrame, by: Sequence[str], order: str = "created_at", id_column: str = "file_id") -> DataFrame:
    """(by, id): the newest record of each group, of ties that of the greatest id."""
    return records.groupBy(*by).agg(F.max_by(id_column, F.struct(order, id_column)).alias(id_column))


def listing(records: DataFrame, order: str = "created_at", id_column: str = "file_id") -> DataFrame:
    """All records, newest first."""
    return records.orderBy(F.desc(order), F.desc(id_column))


def not_yet_there(uploads: DataFrame, files: DataFrame) -> DataFrame:
    """Uploads (name, content or hash) whose hash no file has, nor whose name; of equal hashes or names among themselves one stays, the least name, then hash."""
    with_hash = uploads if "hash" in uploads.columns else uploads.withColumn("hash", F.sha2(F.col("content").cast("binary"), 256))
    new = with_hash.join(files.select("hash").distinct(), "hash", "left_anti").join(files.select("name").distinct(), "name", "left_anti")
    by_hash = new.groupBy("hash").agg(F.min("name").alias("name"))
    return by_hash.groupBy("name").agg(F.min("hash").alias("hash"))


def unique_by_id(items: DataFrame, id_column: str = "id") -> DataFrame:
    """One row for each id, and all rows without one."""
    named = items.where(F.col(id_column).isNotNull()).dropDuplicates([id_column])
    return named.unionByName(items.where(F.col(id_column).isNull()))


def id_counts(items: DataFrame, id_column: str = "id") -> DataFrame:
    """(n_rows, n_repeated, n_without_id)"""
    n, distinct, named = F.count(F.lit(1)), F.countDistinct(id_column), F.count(id_column)
    return items.agg(n.alias("n_rows"), (named - distinct).alias("n_repeated"), (n - named).alias("n_without_id"))


def unpaired(files: DataFrame, documents: DataFrame) -> DataFrame:
    """(kind, id): files that no document names (`orphan`), documents whose file is missing or unnamed (`dangling`)."""
    orphans = files.join(documents.where("file_id is not null").select("file_id").distinct(), "file_id", "left_anti")
    dangling = documents.join(files.select("file_id").distinct(), "file_id", "left_anti")
    return orphans.select(F.lit("orphan").alias("kind"), F.col("file_id").cast("string").alias("id")).unionByName(dangling.select(F.lit("dangling").alias("kind"), F.col("doc_id").cast("string").alias("id")))


def repeated_names(files: DataFrame) -> DataFrame:
    return files.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def orphan_timeline(files: DataFrame, documents: DataFrame) -> DataFrame:
    """(period, day, n): orphans from before the first document (`history`), after it (`anomaly`), and without a date (`undated`)."""
    orphans = files.join(documents.where("file_id is not null").select("file_id").distinct(), "file_id", "left_anti")
    first = documents.agg(F.min("created_at").alias("__first"))
    period = F.when(F.col("created_at").isNull(), "undated").when(F.col("__first").isNull() | (F.col("created_at") < F.col("__first")), "history").otherwise("anomaly")
    return orphans.crossJoin(F.broadcast(first)).groupBy(period.alias("period"), F.to_date("created_at").alias("day")).agg(F.count(F.lit(1)).alias("n"))


def timestamp(text: Column) -> Column:
    """The instant of an ISO time; without a zone it is in UTC, whatever the session's zone; what can't be read is null."""
    zoned = F.when(~text.rlike(":"), F.concat(text, F.lit("T00:00:00Z"))).when(text.rlike(r"(Z|[+-]\d\d(:?\d\d)?)$"), text).otherwise(F.concat(text, F.lit("Z")))
    return F.try_to_timestamp(zoned)


def verdict(broken: DataFrame, counts: DataFrame) -> DataFrame:
    """(verdict): 2 if an item couldn't be read (has no id), 1 if a file or document has no partner, else 0."""
    n = broken.agg(F.count(F.lit(1)).alias("n_broken"))
    return counts.crossJoin(F.broadcast(n)).select(F.when(F.col("n_without_id") > 0, 2).when(F.col("n_broken") > 0, 1).otherwise(0).alias("verdict"))


def stale_history(files: DataFrame, documents: DataFrame, category: str = "historical") -> DataFrame:
    """(newest_file, indexed): the newest file of the category, and whether a document names it."""
    top = files.where(F.col("category") == category).agg(F.max_by("file_id", F.struct("created_at", "file_id")).alias("file_id"))
    known = documents.select("file_id").where("file_id is not null").distinct().withColumn("indexed", F.lit(True))
    return top.join(known, "file_id", "left").select(F.col("file_id").alias("newest_file"), F.coalesce("indexed", F.lit(False)).alias("indexed"))


def category_counts(files: DataFrame, documents: DataFrame) -> DataFrame:
    """(category, n, indexed): files of each category, and how many of them a document names."""
    known = documents.select("file_id").where("file_id is not null").distinct().withColumn("__known", F.lit(1))
    return files.join(known, "file_id", "left").groupBy("category").agg(F.count(F.lit(1)).alias("n"), F.count("__known").alias("indexed"))


def bad_records(records: DataFrame) -> DataFrame:
    """Records of an unknown category, or without what a record must have; must be empty before they are appended."""
    needed = [f.name for f in RECORD.fields if not f.nullable]
    bad = ~F.coalesce(F.col("category").isin(*CATEGORIES), F.lit(False))
    for c in needed:
        bad = bad | F.col(c).isNull()
    return records.where(bad)


def append(records: DataFrame, path: str) -> None:
    if not bad_records(records).isEmpty():
        raise PanelError("records of an unknown category or without required fields")
    records.select(*(F.col(f.name).cast(f.dataType) for f in RECORD.fields)).write.mode("append").parquet(path)


def record(records: DataFrame, file_id) -> DataFrame:
    return records.where(F.col("file_id") == F.lit(file_id))


def changed(records: DataFrame, changes: DataFrame, id_column: str = "file_id") -> DataFrame:
    """records with the fields that changes (id, fields) sets; a null leaves a field as it is."""
    fields = [c for c in changes.columns if c != id_column]
    new = changes.select(id_column, *(F.col(c).alias(f"__{c}") for c in fields))
    joined = records.join(new, id_column, "left")
    return joined.withColumns({c: F.coalesce(f"__{c}", c) for c in fields}).select(*records.columns)


def files_of(spark: SparkSession, path: str, pattern: str = "*", largest: int = 256 << 20) -> DataFrame:
    """(name, path, size, modified, hash) of the files below path whose names fit the pattern; hash is the SHA-256 of a file's bytes.

    Files are read by the tasks that hash them, each whole. Those of more than `largest` bytes would not fit a task: their hash is null (unhashed finds them), and their bytes aren't
    read. Spark's reader leaves empty files out.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    found = reader.load(path)
    named = lambda df, hash_: df.select(F.element_at(F.split("path", "/"), -1).alias("name"), "path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), hash_.alias("hash"))
    # the source drops files by their length before it reads them
    small = named(found.where(F.col("length") <= largest), F.sha2("content", 256))
    return small.unionByName(named(found.where(F.col("length") > largest), F.lit(None).cast("string")))


def hashed(contents: DataFrame) -> DataFrame:
    """(name, path, size, modified, hash) of contents (path, modified, content) that are rows of a table: what files_of gives for files of these bytes."""
    name = F.element_at(F.split("path", "/"), -1)
    return contents.select(name.alias("name"), "path", F.octet_length("content").cast("long").alias("size"), "modified", F.sha2("content", 256).alias("hash"))


def unhashed(files: DataFrame) -> DataFrame:
    """(path, size) of files too large to be hashed."""
    return files.where("hash is null").select("path", "size")


def copies(files: DataFrame) -> DataFrame:
    """(path, first, by): of files of equal content (`hash`), and else of equal name (`name`), all but the first, with the path of the first.

    The first of several is the one modified earliest, then that of the least path. Files without a hash are compared by name alone. The table is read
    several times, so what files_of or hashed give should be written before, or the bytes are hashed each time.
    """
    def later(rows: DataFrame, key: str) -> DataFrame:
        first = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct("modified", "path")).alias("__first"))
        return rows.join(first, key).where(F.col("path") != F.col("__first.path")).select("path", F.col("__first.path").alias("first"), F.lit(key).alias("by"))

    by_hash = later(files, "hash")
    rest = files.join(by_hash.select("path"), "path", "left_anti")
    return by_hash.unionByName(later(rest, "name"))
