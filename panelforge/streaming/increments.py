"""Incremental runs: origins as they arrive, and monthly corrections."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.transforms import replay
from ..operators.affected import changed_ranges, replayed_cells
from ..operators.align import align, with_steps
from ..operators.evaluate import chosen, curve_states, merged, merged_curve, ranked_values, states, values
from ..operators.update import overwrite
from ..schema import PanelError
from ..sources.versions import Folder, Version


def score_origins(spark: SparkSession, path: str, schema: str, checkpoint: str, sink: Callable[[DataFrame, int], None], files: int = 1):
    """Every new file below path (origin=.../ directories) goes to the sink, a few at a time; ends when all that is there is done.

    The sink gets (rows, batch number) and must give the same result if it is called again for one batch. An origin's files may
    be spread over several batches.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def per_origin(out: str) -> Callable[[DataFrame, int], None]:
    """A sink that replaces what a batch gave to each origin (directories origin=.../batch=...), and so may run twice; see origin_rows."""

    def sink(rows: DataFrame, number: int) -> None:
        batch = rows.withColumn("batch", F.lit(number))
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("origin", "batch").parquet(out)

    return sink


def origin_rows(spark: SparkSession, out: str) -> DataFrame:
    """The rows of all batches that per_origin wrote."""
    return spark.read.parquet(out).drop("batch")


def kept_states(out: str, actuals: DataFrame, steps: DataFrame, metrics: Sequence[str], options: dict[str, dict] | None = None) -> Callable[[DataFrame, int], None]:
    """A sink that joins a batch's forecasts (origin, time, unit, y_pred) to the actuals and steps and keeps the states of the batch's groups; see streamed_scores.

    States are as many rows as a batch has groups, and for AP and AUC as many as its groups have distinct mean forecasts; no row of forecasts is kept. A batch that
    runs again replaces what it gave. A batch of which nothing is aligned gives nothing.
    """
    plain = chosen(metrics, options)

    def sink(rows: DataFrame, number: int) -> None:
        aligned = with_steps(align(rows, actuals), steps).persist()
        try:
            parts = [("states", states(aligned, metrics, options))] * bool(plain) + [("curve", curve_states(aligned))] * (len(plain) < len(metrics))
            for name, found in parts:
                found.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{out}/{name}")
        finally:
            aligned.unpersist()

    return sink


def streamed_scores(spark: SparkSession, out: str, metrics: Sequence[str], cut_to_shortest: bool = True, options: dict[str, dict] | None = None) -> DataFrame:
    """What scored() gives for the rows of all batches of kept_states, which took the same metrics and options: their states are merged, and then valued."""
    plain, found = chosen(metrics, options), []
    if plain:
        found.append(values(merged(spark.read.parquet(f"{out}/states"), metrics, options), metrics, cut_to_shortest, options))
    if len(plain) < len(metrics):
        found.append(ranked_values(merged_curve(spark.read.parquet(f"{out}/curve")), metrics, cut_to_shortest))
    return reduce(DataFrame.unionByName, found)


def batches(spark: SparkSession, folder: str, schema: T.StructType, after: int) -> DataFrame:
    """(schema, batch): what batches of a later number have below folder (batch=...); others aren't read."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema).withColumn("batch", F.lit(0))
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])).parquet(folder).where(F.col("batch") > after)


def write_batch(rows: DataFrame, folder: str, number: int) -> None:
    """The rows as that batch of the folder, in place of what it gave before."""
    rows.withColumn("batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(folder)


def last_values(rows: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    """(keys, names) of rows (.., batch): of each cell the last value of each field that isn't null, so that a later correction of one field leaves an earlier one of another."""
    return rows.groupBy(*keys).agg(*(F.max_by(c, F.when(F.col(c).isNotNull(), F.col("batch"))).alias(c) for c in names))


def corrections(spark: SparkSession, panel: str, versions: str, keys: tuple[str, str]) -> tuple[DataFrame, Version | None]:
    """(the corrections of each cell that is corrected, the base that holds the earlier ones): one row a cell."""
    schema = spark.read.parquet(panel).schema
    names = [c for c in schema.names if c not in keys]
    base = Folder(spark, versions).current()
    rows = batches(spark, f"{versions}/batches", schema, base.facts["upto"] if base else -1)
    if base:
        rows = rows.unionByName(spark.read.schema(schema).parquet(base.path).withColumn("batch", F.lit(-1)))
    return last_values(rows, keys, names), base


def compact(spark: SparkSession, panel: str, versions: str, keys: tuple[str, str]) -> Version | None:
    """Merges the base and all batches after it into a new base of one row a cell, which counts from one moment to the next; None if there is nothing new.

    Reading then costs the base and what comes later, however many batches there were. Readers that have begun with the old base
    keep it and its batches until the next call; a call that stops midway leaves all as it was. One caller at a time: a second one is refused.
    """
    folder = Folder(spark, versions)
    numbers = [int(n.partition("=")[2]) for n in folder.names("batches") if n.startswith("batch=")]
    with folder.writing() as own:
        upto = own.before.facts["upto"] if own.before else -1
        if max(numbers, default=-1) <= upto:
            return None
        corrections(spark, panel, versions, keys)[0].write.parquet(own.path)
        new = own.commit(upto=max(numbers), since=upto)
        for n in numbers:
            if n <= upto:
                folder.files.delete(folder.at("batches", f"batch={n}"), True)
    return new


def arrived(spark: SparkSession, path: str, schema: str, checkpoint: str, panel: str, versions: str, keys: tuple[str, str], files: int = 1) -> None:
    """Takes the corrections that have arrived as files so far into batches below versions, those of one cell reduced to the one of greatest `arrived`; see corrections."""
    names = [c for c in spark.read.parquet(panel).columns if c not in keys]

    def sink(rows: DataFrame, number: int) -> None:
        shared = [c for c in names if c in rows.columns]
        latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*shared), "arrived").alias("__new")).select(*keys, "__new.*")
        write_batch(latest, f"{versions}/batches", number)

    query = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception():
        raise PanelError(str(query.exception()))


def apply_corrections(spark: SparkSession, path: str, schema: str, checkpoint: str, panel: str, versions: str, keys: tuple[str, str], columns=None, files: int = 1) -> DataFrame:
    """The panel with the corrections laid over it that have arrived as files so far; columns are made anew from it (replay).

    Of several corrections of a cell the one of the latest batch counts, and in a batch that of greatest `arrived`. A batch writes its own
    corrections below `versions`, nothing else, so the panel isn't copied; a batch that runs again writes the same
    again, and a call without new files gives what the call before gave. compact() keeps many batches from being read each time, and
    refreshed() makes only those derived cells anew that corrections touch.
    """
    arrived(spark, path, schema, checkpoint, panel, versions, keys, files)
    found = overwrite(spark.read.parquet(panel), corrections(spark, panel, versions, keys)[0], keys)
    return replay(found, keys, columns) if columns else found


def refreshed(spark: SparkSession, panel: str, versions: str, derived: str, keys: tuple[str, str], columns, extra=None) -> tuple[DataFrame, dict[str, int]]:
    """(the replayed panel with all corrections so far, {"touched", "needed"}: derived cells made anew and cells read for it).

    The first call replays the whole panel into `derived`. A later one takes the cells that batches since then have, makes anew the derived cells
    that these touch (operators.affected), and writes them as a batch that lies over the earlier ones; a call without new batches makes nothing. A call that stops midway is
    done again by the next.
    """
    folder, source = Folder(spark, derived), Folder(spark, versions)
    base_of_corrections = source.current()
    numbers = [int(n.partition("=")[2]) for n in source.names("batches") if n.startswith("batch=")] + ([base_of_corrections.facts["upto"]] if base_of_corrections else [])
    newest = max(numbers, default=-1)
    now = overwrite(spark.read.parquet(panel), corrections(spark, panel, versions, keys)[0], keys)
    base, counts = folder.current(), {"touched": 0, "needed": 0}
    if base is None:
        with folder.writing() as own:
            replay(now, keys, columns, extra).write.parquet(own.path)
            base = own.commit(upto=newest)
        counts = dict.fromkeys(counts, spark.read.parquet(base.path).count())
        return spark.read.parquet(base.path), counts
    schema = spark.read.parquet(base.path).schema
    done = max([base.facts["upto"], *(int(n.partition("=")[2]) for n in folder.names("batches") if n.startswith("batch="))])
    if newest > done:
        raw = spark.read.parquet(panel).schema
        if base_of_corrections and base_of_corrections.facts["since"] > done:
            # compacted twice since: the batches are gone, and every corrected cell counts as changed
            changed = corrections(spark, panel, versions, keys)[0]
        else:
            changed = batches(spark, f"{versions}/batches", raw, done)
        cells, read = replayed_cells(now, changed_ranges(changed, keys), keys, columns, extra)
        write_batch(cells.select(*schema.names), f"{derived}/batches", newest)
        counts = {"touched": batches(spark, f"{derived}/batches", schema, newest - 1).count(), "needed": read.count()}
    over = batches(spark, f"{derived}/batches", schema, base.facts["upto"])
    names = [c for c in schema.names if c not in keys]
    last = over.groupBy(*keys).agg(F.max_by(F.struct(*names), "batch").alias("__new"))
    found = spark.read.parquet(base.path).join(last, list(keys), "left")
    return found.select(*keys, *(F.when(F.col("__new").isNotNull(), F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) for c in names)).select(*schema.names), counts
