"""Event lines of both routes as one stream.

Finalized and deleted objects arrive in folders of their own. Both are read as
file streams of limited rate, validated once, and split: sound events of images
go to the folder that the live reconcile reads, lines that break a rule to a
quarantine with their text and reason. Both sinks belong to one query, so a
line is counted once, whatever is restarted.
"""

from pyspark.sql import functions as F

from auditloom.operators import events
from auditloom.plans.jobs import kept
from auditloom.sources import tables
from auditloom.sources.events import parse_events

ACCEPTED = "gcs_uri string, kind string, generation bigint"
REJECTED = "kind string, line string, reason string"


def read_routes(spark, finalized, deleted, files=None):
    """The event lines of both folders, at most `files` files of each a batch."""

    def route(path, kind):
        reader = spark.readStream.option("maxFilesPerTrigger", files) if files else spark.readStream
        return parse_events(reader.text(path).withColumn("line", F.col("value"))).withColumn("kind", F.lit(kind))

    return route(finalized, "finalize").unionByName(route(deleted, "delete"))


def split_batch(batch, number, accepted, rejected):
    """Write one batch's sound events and its rejected lines, each to a folder of the batch."""
    checked = kept(events.validate_events(batch), "arrivals")
    good, bad = events.quarantine(checked)
    good = events.supported_images(good).select("gcs_uri", "kind", "generation")
    tables.write_batch(good, accepted, number)
    tables.write_batch(bad.select("kind", "line", "reason"), rejected, number)


def start_arrivals(lines, accepted, rejected, checkpoint, trigger=None):
    """Validate the lines of `read_routes` as they come."""
    return (
        lines.writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, number: split_batch(batch, number, accepted, rejected))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
