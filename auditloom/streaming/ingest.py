"""Responses as a stream: scored rows to one table, failures to another."""

from pyspark.sql import functions as F

from auditloom.operators import responses
from auditloom.sources.tables import newest_batches, write_batch


def start_ingest(stream, rows_path, errors_path, checkpoint, trigger=None, text_col="response"):
    """Flatten each micro-batch into rows and errors.

    Each batch owns one folder per table and replaces it when it is run again,
    so a retried batch leaves no duplicates.
    """

    def write(batch, number):
        scored = responses.score_rows(responses.parse_responses(batch, text_col))
        # The text and its parsed forms, by far the widest columns, are not kept.
        scored = scored.drop("doc", "root", text_col).persist()
        try:
            write_batch(responses.explode_rows(scored), rows_path, number)
            failed = scored.where("reason is not null").drop("rows")
            write_batch(failed, errors_path, number)
        finally:
            scored.unpersist()

    return (
        stream.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_rows(spark, path, keys):
    """Rows of the newest batch of each key: a task delivered twice counts once."""
    rows = spark.read.parquet(path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return newest_batches(rows, keys).drop("batch_id")
