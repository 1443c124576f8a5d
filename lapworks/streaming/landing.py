"""Landed payload files -> Bronze table, incrementally.

``readStream`` picks up new payload files in the landing folder; each
micro-batch is classified, exploded, typed with a fixed schema, normalised
(sentinels, NaN, void, audit) and written to the Bronze table.  The stream's
checkpoint (offsets and commits) lives in the shared folder, so a restarted or
re-run job ingests each file once; each batch's rows carry ``_batch`` (the batch
id) and the write replaces only that batch's partition, so a batch replayed after
a failure between its write and its commit replaces itself instead of appending
twice.  Payloads and entries that are no records go to ``<table>_rejected``, with the
reason, in the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lapworks.operators import bronze
from lapworks.session import materialize
from lapworks.sources import payloads
from lapworks.sources.tables import write_table


def ingest_stream(spark: SparkSession, landing: str, table: str, schema: StructType, checkpoint: str,
                  *, race_location: str | None = None, as_of=None, max_files: int = 1000,
                  available_now: bool = True):
    stream = (spark.readStream.format("text").option("wholetext", True)
              .option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", True)
              .load(landing)
              .select(F.col("_metadata.file_path").alias("source"), F.col("value").alias("payload")))

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        # parsed once, for both tables; the rejects go first, so that a batch whose records
        # are there has its rejects there as well
        rows = materialize(payloads.parsed(batch))
        bad = rows.filter("reason IS NOT NULL").drop("rec").withColumn("_batch", F.lit(epoch_id))
        write_table(bad, f"{table}_rejected", partition_by="_batch", dynamic=True, require_rows=True)
        recs = payloads.to_columns(rows.filter("reason IS NULL").drop("reason", "content"), schema)
        out = bronze.normalise(recs, race_location, as_of=as_of).withColumn("_batch", F.lit(epoch_id))
        write_table(out, table, partition_by="_batch", dynamic=True)

    q = stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="30 seconds")
    return q.start()


def ingest_available(spark: SparkSession, landing: str, table: str, schema: StructType,
                     checkpoint: str, **kw) -> DataFrame:
    """Run one ``availableNow`` pass (only files not yet committed in ``checkpoint``),
    wait for it, and return the refreshed table (micro-batches write through the
    stream's own session, so this session's cached file listing is refreshed)."""
    ingest_stream(spark, landing, table, schema, checkpoint, available_now=True, **kw).awaitTermination()
    spark.catalog.refreshTable(table)
    return spark.read.table(table)
