"""A pool of items and its log, published together by versions."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from quillbank.operators.intake import LOG, current_log, live_rows, plan_intake


class ItemStore:
    """Pool and log under one folder, seen by readers only through the last manifest.

    A batch writes its rows and its log entries to folders of its own and then publishes both by one manifest that
    lists all batches; the manifest is renamed into place, and the rename fails if that version exists already. A batch that
    dies before is not seen, and its rerun writes the same folders again; a batch that was published is not run again.
    So every batch counts once, wholly or not at all.
    """

    def __init__(self, spark: SparkSession, folder: str, columns: str):
        """``columns``: the schema of a batch (file, file_hash, row_id, content_key …)."""
        self.spark, self.folder, self.columns = spark, folder.rstrip("/"), columns
        self.pool_schema = f"import_id string, batch string, {columns}"

    def _files(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/manifest")
        return jvm.org.apache.hadoop.fs.Path, path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def manifest(self) -> tuple[int, list[str]]:
        """The last version (0: none) and its batches, the oldest first."""
        path, at, fs = self._files()
        if not fs.exists(at):
            return 0, []
        versions = [int(n[1:]) for s in fs.listStatus(at) if (n := s.getPath().getName()).startswith("v") and n[1:].isdigit()]
        if not versions:
            return 0, []
        text = self.spark.read.text(f"{self.folder}/manifest/v{max(versions)}", wholetext=True).first()[0]
        return max(versions), json.loads(text)

    def _publish(self, version: int, batches: list[str]) -> None:
        path, at, fs = self._files()
        fs.mkdirs(at)
        draft, final = path(at, f"draft-{uuid.uuid4().hex}"), path(at, f"v{version}")
        out = fs.create(draft, False)
        out.write(bytearray(json.dumps(batches).encode()))
        out.close()
        # unlike FileSystem.rename this never replaces a file
        jvm = self.spark.sparkContext._jvm
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        none = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), none)

    def _read(self, kind: str, schema: str, batches: list[str]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.folder}/{kind}/{b}" for b in batches])

    def log(self, batches: list[str] | None = None) -> DataFrame:
        """The last entry of each import."""
        return current_log(self._read("log", LOG, self.manifest()[1] if batches is None else batches))

    def pool(self, batches: list[str] | None = None) -> DataFrame:
        """The rows that count."""
        batches = self.manifest()[1] if batches is None else batches
        return live_rows(self._read("pool", self.pool_schema, batches), self._read("log", LOG, batches))

    def commit(self, batch_id: str, batch: DataFrame, failed: DataFrame, links: DataFrame, force: bool = False) -> bool:
        """Take in a batch (:func:`plan_intake`); false if it was taken in before. Ids are names of folders."""
        version, batches = self.manifest()
        if batch_id in batches:
            return False
        rows, entries = plan_intake(batch, failed, self._read("pool", self.pool_schema, batches), self._read("log", LOG, batches), links, batch_id, version + 1, force)
        rows.write.mode("overwrite").parquet(f"{self.folder}/pool/{batch_id}")
        entries.write.mode("overwrite").parquet(f"{self.folder}/log/{batch_id}")
        self._publish(version + 1, [*batches, batch_id])
        return True

    def compact(self, batch_id: str) -> None:
        """Publish one batch that holds what counts instead of all; old folders stay for readers of old versions."""
        version, batches = self.manifest()
        self.pool(batches).write.mode("overwrite").parquet(f"{self.folder}/pool/{batch_id}")
        self.log(batches).write.mode("overwrite").parquet(f"{self.folder}/log/{batch_id}")
        self._publish(version + 1, [batch_id])
