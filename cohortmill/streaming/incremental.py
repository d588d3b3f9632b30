"""Files are taken in batches as they arrive, routed to their outputs and appended as Parquet; a checkpoint gives resume.

A batch stores the paths of its files and no more: the stream is one of paths, it opens no file. Groups of batches are then
settled together: their files are read once, each output's rows are written, and then the group's part of the ledger, which
files it took, what they fed and how it ended.
Groups grow with the batches before them (1, 1, 2, 4, ...), so that a backlog of any number of batches is settled in a
number of steps that grows with its logarithm. Inputs are deleted by the ledger, after the stream has committed the
batches that took them, so a batch that fails finds its files again when it runs anew.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.assays import BY, columns_of, listed_files, options_of, outputs_of, project_assay, resolve_files, stored_lines
from ..sources.delimited import near
from ..sources.scratch import folders, remove, stored
from ..sources.tables import exists, qualified

#: Folder of lines that feed no output.
NONE = "-"
LEDGER = "batch long, path string, file_id string, output string, n_lines long, outcome string"
DELETED = "batch long, path string, deleted boolean"
TAKEN = "path string, name string, batch long"
FILES = "path string, modificationTime timestamp, length long, content binary"


def normalise_stream(spark: SparkSession, root: str, manifest: DataFrame, out: str, checkpoint: str, *, recipes: list[str], options: dict[str, Any] | None = None, files_per_batch: int = 200, delete_handled: bool = False):
    """Processes every file below ``root`` that no earlier run has, and returns the finished query.

    ``foreachBatch`` stores a batch's paths under ``<out>/_taken/batch=<n>``; the files must stay until they are settled. Settled, each output's rows lie under
    ``<out>/<output>/batch=<first>`` and the ledger under ``<out>/_ledger/batch=<first>``, by the first batch of their
    group. A group that fails is settled again from the same first batch and replaces its own folders, so rows appear once.
    Files that the manifest does not list, or that feed no output of the recipes, are entered as ``unrouted`` and stay.
    With ``delete_handled``, files whose batch is committed and that were written are deleted.
    """
    reader = spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", str(files_per_batch)).option("recursiveFileLookup", "true")
    raw = reader.load(root).select(F.col("_metadata.file_path").alias("path"), F.col("path").alias("name"))
    names = outputs_of(recipes, options)
    wanted = {n: columns_of(n, options) for n in names}
    files = listed_files(spark, root, manifest, names)  # the run takes what is there now
    kept = near(stored(files.select("path", "output").distinct(), "stream-files"))
    done = [last_settled(spark, out)]

    def settle(session: SparkSession, last: int) -> None:
        held = folders(session, f"{out}/_taken", "batch=")
        for old in (n for n in held if n <= done[0]):
            remove(session, f"{out}/_taken/batch={old}")
        pending = [n for n in held if done[0] < n <= last]
        if not pending:
            return
        first = min(pending)
        taken = session.read.schema(TAKEN).parquet(f"{out}/_taken").filter(F.col("batch").between(first, last))
        by = (*BY, "batch")
        lines = stored_lines(session, stored(taken.join(kept, "path", "left").fillna(NONE, ["output"]), "stream-taken"), by)
        resolved = resolve_files(lines.filter(F.col("output") != NONE), files, names, by)
        for name in names:
            rows = project_assay(lines, resolved, name, wanted[name], options_of(options, name), by)
            rows.write.mode("overwrite").parquet(f"{out}/{name}/batch={first}")
        counted = lines.groupBy("batch", "path", "output").agg(F.count("*").alias("n_lines"))
        ids = files.select("path", "file_id") if "file_id" in files.columns else files.select("path", F.lit(None).cast("string").alias("file_id"))
        outcome = F.when(F.col("output") == NONE, "unrouted").otherwise("written")
        entry = counted.join(near(ids.distinct()), "path", "left").select(F.col("batch").alias("taken"), "path", "file_id", F.nullif("output", F.lit(NONE)).alias("output"), "n_lines", outcome.alias("outcome"))
        entry.write.mode("overwrite").parquet(f"{out}/_ledger/batch={first}")
        done[0] = last
        for n in pending:
            remove(session, f"{out}/_taken/batch={n}")

    def handle(batch: DataFrame, number: int) -> None:
        if number <= done[0]:
            return  # settled by a run that ended before it could commit this batch
        batch.coalesce(1).write.mode("overwrite").parquet(f"{out}/_taken/batch={number}")  # a row per file
        if number & (number + 1) == 0:
            if delete_handled:
                sweep(batch.sparkSession, out, before=number)
            settle(batch.sparkSession, number)

    query = raw.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    settle(spark, max(folders(spark, f"{out}/_taken", "batch="), default=-1))
    if delete_handled:
        sweep(spark, out)
    return query


def last_settled(spark: SparkSession, out: str) -> int:
    """The last batch in the ledger; -1 without any."""
    last = ledger(spark, out).agg(F.max("batch")).first()[0]
    return -1 if last is None else last


def ledger(spark: SparkSession, out: str) -> DataFrame:
    """(batch, path, file_id, output, n_lines, outcome): a row per file that a batch has taken, and its outcome."""
    if not exists(spark, f"{out}/_ledger"):
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.schema(f"{LEDGER}, taken long").parquet(f"{out}/_ledger")  # a folder bears the first batch of its group
    return rows.withColumn("batch", F.coalesce("taken", "batch")).drop("taken")


def deletions(spark: SparkSession, out: str) -> DataFrame:
    if not exists(spark, f"{out}/_deleted"):
        return spark.createDataFrame([], DELETED)
    return spark.read.schema(DELETED).parquet(f"{out}/_deleted")


def sweep(spark: SparkSession, out: str, before: int | None = None) -> int:
    """Deletes the written files of the ledger's batches below ``before`` (of all without it) that are still there.

    At most the files of the batches since the last sweep pass through the driver, as paths. Returns their number.
    """
    due = ledger(spark, out).filter("outcome = 'written'")
    due = due if before is None else due.filter(F.col("batch") < before)
    rows = due.join(deletions(spark, out).select("batch").distinct(), "batch", "left_anti").select("batch", F.expr("url_decode(replace(path, '+', '%2B'))").alias("name"), "path").distinct().collect()
    if rows:
        gone = [(r["batch"], r["path"], remove(spark, r["name"])) for r in rows]
        told = spark.createDataFrame(gone, DELETED).repartition("batch")
        told.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{out}/_deleted")
    return len(rows)


def normalised(spark: SparkSession, out: str, output: str) -> DataFrame:
    """All rows of one output, over all settled batches."""
    return spark.read.parquet(f"{out}/{output}").drop("batch")


def handled_status(spark: SparkSession, manifest: DataFrame, root: str, out: str) -> DataFrame:
    """The manifest as it stands by the ledger: deleted files have the status ``processed_deleted`` and no path.

    Files that no batch has taken, or whose batch is not committed, keep their status.
    """
    base = qualified(spark, root)
    gone = deletions(spark, out).select(F.expr(f"substring(url_decode(replace(path, '+', '%2B')), {len(base) + 2})").alias("local_path")).distinct().withColumn("_gone", F.lit(True))
    rows = manifest.join(gone, "local_path", "left")
    status = F.when(F.col("_gone"), F.lit("processed_deleted")).otherwise(F.col("status"))
    return rows.withColumns({"status": status, "local_path": F.when(F.col("_gone").isNull(), F.col("local_path"))}).select(*manifest.columns)


__all__ = ["deletions", "handled_status", "ledger", "normalise_stream", "normalised", "sweep"]
