"""Intake of files of items: what a batch changes in the pool and in its log, without changing anything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A log entry: an import is known by an id that it keeps when its file comes again; ``data`` is the batch whose rows count.
LOG = "import_id string, file string, file_hash string, state string, inserted long, duplicates long, error string, data string, version long"


def current_log(log: DataFrame) -> DataFrame:
    """The last entry of each import."""
    last = F.row_number().over(Window.partitionBy("import_id").orderBy(F.desc("version")))
    return log.withColumn("_nth", last).filter("_nth = 1").drop("_nth")


def live_rows(pool: DataFrame, log: DataFrame) -> DataFrame:
    """Rows of the pool that count: those that the last completed entry of their import wrote."""
    now = current_log(log).filter("data is not null").select("import_id", F.col("data").alias("batch"))
    return pool.join(now, ["import_id", "batch"], "left_semi")


def plan_intake(batch: DataFrame, failed: DataFrame, pool: DataFrame, log: DataFrame, links: DataFrame, batch_id: str, version: int, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """New pool rows (``import_id, batch`` and the columns of ``batch``) and log entries (``LOG``) of a batch of files.

    ``batch``: file, file_hash, row_id, content_key and what else an item has; ``failed``: file, file_hash, error (files
    that couldn't be read); ``pool`` and ``log``: what is stored; ``links``: row_id of items that banks use.

    A file belongs to the import that last had its content, else to the one that last had its name, else to a new
    one. A completed import with the same content is left alone (no entry) unless ``force``; of equal files in a batch the
    first by name counts. An import whose counting rows a bank uses is not replaced: its entry is ``ERROR`` with
    ``LINKED:n``, like that of a failed file, and its old rows keep counting. All others are ``COMPLETED``: their
    new rows replace the old ones. A row whose key a counting row of another import or an earlier row (by row_id) of the
    batch has is a duplicate and isn't stored.
    """
    now = current_log(log)
    live = live_rows(pool, log)
    files = batch.select("file", "file_hash").distinct().withColumn("broken", F.lit(None).cast("string"))
    files = files.unionByName(failed.groupBy("file", "file_hash").agg(F.min("error").alias("broken")))
    first = F.row_number().over(Window.partitionBy("file_hash").orderBy(F.col("broken").isNotNull(), "file"))
    files = files.withColumn("nth", first).filter("nth = 1").drop("nth")

    newest = lambda name: F.max_by(F.struct("import_id", "file_hash", "state", "data"), F.struct("version", "import_id")).alias(name)
    found = files.join(now.groupBy("file_hash").agg(newest("same")), "file_hash", "left").join(now.groupBy("file").agg(newest("named")), "file", "left")
    found = found.withColumn("old", F.coalesce("same", "named")).drop("same", "named")
    unchanged = (F.col("old.file_hash") == F.col("file_hash")) & (F.col("old.state") == "COMPLETED")
    found = found.filter(~F.coalesce(unchanged, F.lit(False)) | F.lit(force) | F.col("broken").isNotNull())
    used = live.join(links.select("row_id").distinct(), "row_id", "left_semi").groupBy("import_id").agg(F.count("*").alias("used"))
    # two files of a batch for one import: the second waits
    import_id = F.coalesce(F.col("old.import_id"), F.concat(F.lit(f"{batch_id}/"), F.col("file")))
    found = found.withColumn("import_id", import_id).withColumn("nth", F.row_number().over(Window.partitionBy("import_id").orderBy("file"))).filter("nth = 1").join(used, "import_id", "left")
    error: Column = F.coalesce(F.col("broken"), F.when(F.col("used") > 0, F.concat(F.lit("LINKED:"), F.col("used").cast("string"))))
    found = found.select("import_id", "file", "file_hash", error.alias("error"), F.col("old.data").alias("kept"))

    taken = found.filter("error is null").select("import_id", "file", "file_hash")
    rows = batch.join(taken, ["file", "file_hash"])
    others = live.join(taken.select("import_id"), "import_id", "left_anti").select("content_key").distinct()
    fresh = rows.groupBy("content_key").agg(F.min("row_id").alias("row_id")).join(others, "content_key", "left_anti")
    new = rows.join(fresh, ["content_key", "row_id"], "left_semi").dropDuplicates(["content_key", "row_id"])
    n = rows.groupBy("import_id").agg(F.count("*").alias("rows")).join(new.groupBy("import_id").agg(F.count("*").alias("inserted")), "import_id", "left")
    n = n.select("import_id", F.coalesce("inserted", F.lit(0)).alias("inserted"), (F.col("rows") - F.coalesce("inserted", F.lit(0))).alias("duplicates"))
    entries = found.join(n, "import_id", "left").select(
        "import_id", "file", "file_hash", F.when(F.col("error").isNull(), "COMPLETED").otherwise("ERROR").alias("state"), F.coalesce("inserted", F.lit(0)).alias("inserted"), F.coalesce("duplicates", F.lit(0)).alias("duplicates"),
        "error", F.when(F.col("error").isNull(), F.lit(batch_id)).otherwise(F.col("kept")).alias("data"), F.lit(version).cast("long").alias("version"),
    )
    return new.select("import_id", F.lit(batch_id).alias("batch"), *batch.columns), entries
