"""Incremental ingest: new files of a drop folder, once each, by Structured Streaming.

The stream tells which files are new; each micro-batch runs the batch ingest for their trade types and years,
which is idempotent, so a repeated batch after a failure writes the same months again. A file that is sent again with another
size or age is new; changed configuration is the business of ``operators.planning``.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fwloom.plans import ingest
from fwloom.sources.fwf_zip import FORMAT, register


def start(spark: SparkSession, options: ingest.IngestOptions, checkpoint: str) -> StreamingQuery:
    """Handles all files that are there, then stops; run it again for later ones."""
    register(spark)
    # One line of each file is enough to see it.
    files = spark.readStream.format(FORMAT).option("path", options.input_dir).option("encoding", "latin-1").option("maxLines", 1).option("log", f"{checkpoint}/files").load().select("input_path")

    def handle(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        paths = [r["input_path"] for r in batch.distinct().collect()]  # the names of new files
        if not paths:
            return
        from pathlib import Path

        from fwloom import layouts as L
        from fwloom.operators import discovery

        catalog = {t: L.load_all(Path(options.layouts_dir), t) for t in options.trade_types}
        seen = discovery.match(own.createDataFrame([(p,) for p in paths], "path string"), ingest.patterns_of(catalog))
        for r in seen.select("trade_type", "year").distinct().collect():
            ingest.run(own, replace(options, trade_types=(r["trade_type"],), year=r["year"]))

    return files.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
