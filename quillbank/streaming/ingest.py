"""Streaming intake: new files of a folder into the store, once each."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from quillbank.sources.store import ItemStore


def ingest_stream(store: ItemStore, source: str, checkpoint: str, links: DataFrame, name: str = "stream") -> StreamingQuery:
    """Take every new parquet file of ``source`` (the store's columns) into the store, each micro-batch as one version.

    A micro-batch is known by the stream's ``name`` and its number, so one that runs again after a failure is either
    published already or writes the same folders again. Under another name or checkpoint files with known content
    are left alone.
    """
    spark = store.spark
    no_failures = spark.createDataFrame([], "file string, file_hash string, error string")
    rows = spark.readStream.schema(store.columns).parquet(source)
    run = lambda batch, number: store.commit(f"{name}-{number}", batch, no_failures, links) and None
    return rows.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
