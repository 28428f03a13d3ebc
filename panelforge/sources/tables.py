"""Readers and writers of panels, forecasts and metric records."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.audits import content, manifest, require_empty, uneven_months
from ..operators.drift import alerts, checks
from ..schema import LEVELS, PREFIX, PanelError, audit_schema, ensure_double, grid_column, grid_row, rename_features
from .versions import STALE, Folder


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A .csv (with header) or .parquet table."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if path.rstrip("/").endswith(".csv"):
        return reader.csv(path, header=True)
    if path.rstrip("/").endswith(".parquet"):
        return reader.parquet(path)
    raise PanelError(f"can't tell the format of {path}")


def write_table(df: DataFrame, path: str, mode: str = "error") -> None:
    if path.rstrip("/").endswith(".csv"):
        df.write.mode(mode).csv(path, header=True)
    elif path.rstrip("/").endswith(".parquet"):
        df.write.mode(mode).parquet(path)
    else:
        raise PanelError(f"can't tell the format of {path}")


def read_predictions(spark: SparkSession, path: str, level: str, targets: Sequence[str]) -> DataFrame:
    """A forecast table whose keys and arrays are as they must be; the schema is checked without a job."""
    df = audit_schema(spark.read.parquet(path), level, [PREFIX + t for t in targets])
    return df.select(*LEVELS[level], *(PREFIX + t for t in targets))


def prediction_table(df: DataFrame, level: str, targets: Sequence[str]) -> DataFrame:
    """Keys and one float array for each target, as it is published."""
    if level not in ("pgm", "cm"):
        raise PanelError(f"forecasts are of level pgm or cm, not {level}")
    return df.select(*LEVELS[level], *(F.col(PREFIX + t).cast("array<float>").alias(PREFIX + t) for t in targets))


def write_predictions(df: DataFrame, level: str, targets: Sequence[str], path: str, mode: str = "error") -> None:
    """One directory for each month, so that later reads of a few months skip the rest. A month of many rows gets several files."""
    prediction_table(df, level, targets).hint("rebalance", LEVELS[level][0]).write.mode(mode).partitionBy(LEVELS[level][0]).parquet(path)


#: Raw sources by name: (spark, first month, last month, **arguments) -> DataFrame.
SOURCES: dict[str, Callable[..., DataFrame]] = {}


def source(name: str):
    def add(f):
        SOURCES[name] = f
        return f

    return add


def detect_source(descriptor) -> str:
    """The source that a descriptor is for: one with operations is a queryset, one with a pattern synthetic, one with features a region."""
    if isinstance(descriptor, dict):
        for key, name in (("operations", "queryset"), ("pattern", "synthetic"), ("features", "region")):
            if key in descriptor:
                return name
    raise PanelError(f"no source for {descriptor!r}")


def fetch(spark: SparkSession, descriptor: dict, first: int, last: int, **arguments) -> DataFrame:
    return SOURCES[detect_source(descriptor)](spark, first, last, descriptor=descriptor, **arguments)


@source("region")
def fetch_region(spark: SparkSession, first: int, last: int, descriptor: dict, columns: int = 720, fill: bool = True) -> DataFrame:
    """Features of a panel file in a month range, renamed; with fill, missing values are 0 and grid cells have row and column.

    The range and the columns reach the scan; nothing else of the file is read.
    """
    level = descriptor.get("level", "pgm")
    keys, names = LEVELS[level], descriptor["features"]
    names = names if isinstance(names, dict) else {n: n for n in names}
    df = spark.read.parquet(descriptor["path"]).where(F.col(keys[0]).between(first, last)).select(*keys, *names)
    df = rename_features(df, names)
    if not fill:
        return df
    if level == "pgm":
        df = df.withColumns({"row": grid_row(F.col(keys[1]), columns), "col": grid_column(F.col(keys[1]), columns)})
    return ensure_double(df, (*keys, "row", "col")).fillna(0.0, [n for n in names.values()])


@source("queryset")
def fetch_queryset(spark: SparkSession, first: int, last: int, descriptor: dict) -> DataFrame:
    """The month range of a saved queryset's panel, numbers as double."""
    keys = LEVELS[descriptor.get("level", "pgm")]
    return ensure_double(spark.read.parquet(descriptor["path"]).where(F.col(keys[0]).between(first, last)), keys)


def fetch_checked(spark: SparkSession, descriptor: dict, first: int, last: int, model: str, recent: int = 1, **arguments) -> tuple[DataFrame, DataFrame]:
    """What fetch gives, and the drift alerts (model, check, item, rate, threshold, severity) of its numeric features."""
    df = fetch(spark, descriptor, first, last, **arguments)
    keys = LEVELS[descriptor.get("level", "pgm")]
    features = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in (*keys, "row", "col")]
    return df, alerts(checks(df, keys, features, recent), model)


@source("synthetic")
def fetch_synthetic(spark: SparkSession, first: int, last: int, descriptor: dict) -> DataFrame:
    """months x places with patterns of the grid id: `column` (col % 10), `row` (row % 10) or `both` ((row + col) % 20), all from 0."""
    n, wide = descriptor.get("n_entities", 100), descriptor.get("columns", 720)
    places = spark.range(1, n + 1).select(F.col("id").alias("priogrid_id"))
    months = spark.range(first, last + 1).select(F.col("id").cast("int").alias("month_id"))
    cells = places.crossJoin(F.broadcast(months))
    return patterned(cells.withColumns({"row": grid_row(F.col("priogrid_id"), wide), "col": grid_column(F.col("priogrid_id"), wide)}), descriptor["pattern"], descriptor.get("features", ["value"]))


def patterned(cells: DataFrame, pattern: str, features: Sequence[str]) -> DataFrame:
    row, col = F.col("row") - 1, F.col("col") - 1
    values = {"column": col % 10, "row": row % 10, "both": (row + col) % 20}
    if pattern not in values:
        raise PanelError(f"unknown pattern {pattern}")
    return cells.withColumns({f: values[pattern].cast("double") for f in features})


def cached(
    spark: SparkSession, path: str, compute: Callable[[], DataFrame], audit: Callable[[DataFrame], DataFrame] = lambda df: df, use_saved: bool = True, current: Callable[[DataFrame], bool] = lambda df: True, stale: float = STALE
) -> DataFrame:
    """The saved table, if it is wanted, there and current; else the computed one, audited before it is saved. An empty or unreadable one is an error.

    current says whether a saved table still serves, as one of another number of draws doesn't. path is a Folder of versions: a reader sees a
    whole table, the old one until the new one is complete, and a writer that stops midway changes nothing. A second writer is refused while the
    first one writes, or until its mark is older than `stale` seconds.
    """
    folder = Folder(spark, path)
    saved = folder.current() if use_saved else None
    if saved:
        found = spark.read.parquet(saved.path)
        if found.isEmpty():
            raise PanelError(f"{path} is empty")
        if current(found):
            return found
    elif use_saved and folder.names("") and not folder.names("pointers") and not folder.names("versions"):
        raise PanelError(f"{path} holds no saved table")
    with folder.writing(stale) as own:
        audit(compute()).write.parquet(own.path)
        return spark.read.parquet(own.commit().path)


def newest_path(files: DataFrame, prefix: str) -> DataFrame:
    """(path): of the files (name, path) whose name begins so, that of the last name."""
    return files.where(F.col("name").startswith(prefix)).agg(F.max_by("path", "name").alias("path"))


def country_totals(spark: SparkSession, path: str, target: str) -> DataFrame:
    """(month_id, country_id, total array): the country forecast that cells are scaled to; numbers become arrays of one, nothing is filled in."""
    df = spark.read.parquet(path)
    column = PREFIX + target
    total = F.col(column) if isinstance(df.schema[column].dataType, T.ArrayType) else F.when(F.col(column).isNotNull(), F.array(F.col(column)))
    return df.select("month_id", "country_id", total.cast("array<double>").alias("total"))


#: A sink takes (table, metadata). All get the same table.
Sink = Callable[[DataFrame, dict], None]


def to_sinks(df: DataFrame, sinks: Sequence[Sink], metadata: dict) -> None:
    """Every sink in order; the table is kept between them, so that it is computed once."""
    kept = df.persist() if len(sinks) > 1 else df
    try:
        for sink in sinks:
            sink(kept, metadata)
    finally:
        if len(sinks) > 1:
            df.unpersist()


def write_metrics(records: DataFrame, path: str) -> None:
    """One long table, apart by model, run type and target."""
    records.write.mode("append").partitionBy("model", "run_type", "target").parquet(path)


def output_names(df: DataFrame, run_type: str, ts: str, target: str | None = None, origin: int | None = None) -> DataFrame:
    """The parts of an output's name as columns."""
    return df.withColumns({"run_type": F.lit(run_type), "ts": F.lit(ts), "target": F.lit(target), "origin": F.lit(origin).cast("int")})


def prediction_name(run_type: Column, ts: Column, target: Column, origin: Column) -> Column:
    """predictions_<run>_<ts>[_<target>][_NN]; a null target or origin is left out."""
    return F.concat_ws("_", F.lit("predictions"), run_type, ts, target, F.when(origin.isNotNull(), F.lpad(origin.cast("string"), 2, "0")))


def evaluation_name(run_type: Column, target: Column, kind: Column, ts: Column) -> Column:
    """eval_<run>_<target>_<kind>_<ts>"""
    return F.concat_ws("_", F.lit("eval"), run_type, target, kind, ts)


def shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a publication's shards."""
    return spark.read.schema(schema).parquet(f"{path}/shards").select(*schema.names)


def publish(df: DataFrame, path: str, run: str, target: str, provenance: dict[str, str]) -> DataFrame:
    """A shard for each month with where it comes from, then the manifest, which says that all shards are there and what each holds.

    The manifest gives each shard's cells and a fingerprint of its rows that doesn't depend on their order. Months of different cell counts are an error, and so is
    a written table whose content isn't the given one's, with the shards named; then there is no manifest. df is evaluated once: its fingerprint is observed while the
    shards are written, and, being the sum of the shards' own, stands for all of them. A month of many rows gets several files.

    Where shards are there already, from a publication that stopped or was damaged, only those are written again whose rows aren't the
    given ones (stale_shards); df is evaluated for that too, and months that it doesn't have are an error.
    """
    spark = df.sparkSession
    given = df.withColumns({k: F.lit(v) for k, v in provenance.items()})
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/shards")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest"), True)
    writer = lambda rows: rows.hint("rebalance", "month_id").write.partitionBy("month_id")
    if files.exists(folder) and files.listStatus(folder):
        wanted = spark.createDataFrame(prints(given).toArrow())  # a row for each month
        stale = [r.month_id for r in differing(wanted, prints(shards(spark, path, given.schema))).collect()]
        gone = wanted.select("month_id")
        require_empty(shards(spark, path, given.schema).select("month_id").distinct().join(gone, "month_id", "left_anti"), "shards of months that aren't given")
        if stale:
            writer(given.where(F.col("month_id").isin(stale))).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{path}/shards")
        bad = differing(wanted, prints(shards(spark, path, given.schema)))
        require_empty(bad, "shards that aren't what was given")
    else:
        seen = Observation()
        writer(given.observe(seen, *content(given.columns))).parquet(f"{path}/shards")
        written = prints(shards(spark, path, given.schema)).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sum("print").cast("decimal(38,0)").alias("print")).first()
        if written.asDict() != seen.get:
            require_empty(differing(prints(given), prints(shards(spark, path, given.schema))), "shards that aren't what was given")
            raise PanelError("what was written isn't what was given")
    found = shards(spark, path, given.schema)
    if not uneven_months(found).isEmpty():
        raise PanelError("months have different numbers of cells")
    manifest(found, run, target).write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


def prints(df: DataFrame) -> DataFrame:
    """(month_id, n, print): each month's rows, and a hash of their content that doesn't depend on order."""
    return df.groupBy("month_id").agg(*content(df.columns))


def differing(wanted: DataFrame, there: DataFrame) -> DataFrame:
    """(month_id, problem) of the months of wanted whose n or print isn't there's: `missing` or `changed`."""
    both = wanted.join(there.select("month_id", F.col("n").alias("__n"), F.col("print").alias("__print")), "month_id", "left")
    problem = F.when(F.col("__n").isNull(), "missing").when((F.col("n") != F.col("__n")) | ~F.col("print").eqNullSafe(F.col("__print")), "changed")
    return both.select("month_id", problem.alias("problem")).where("problem is not null")


def stale_shards(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """(month_id, problem): shards of a publication, whose rows have this schema, that aren't what its manifest says; must be empty."""
    said = spark.read.parquet(f"{path}/manifest").select(F.explode("months").alias("m")).select("m.month_id", F.col("m.n_cells").alias("n"), "m.print")
    there = prints(shards(spark, path, schema))
    extra = there.join(said, "month_id", "left_anti").select("month_id", F.lit("extra").alias("problem"))
    return differing(said, there).unionByName(extra)


def json_rows(texts: DataFrame, column: str, schema: str) -> DataFrame:
    """A row for each line of JSON; a line that can't be read gives nulls."""
    lines = texts.select(F.explode(F.split(column, "\n")).alias("__line")).where("trim(__line) <> ''")
    return lines.select(F.from_json("__line", schema).alias("__row")).select("__row.*")
