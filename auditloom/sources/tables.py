"""Parquet tables: appends, whole snapshots and their row counts.

The result table (`results.py`) and the job table (`jobtable.py`) are partitioned,
so that a change rewrites only what it touches. Any other table is a folder of snapshots,
`snapshot=00000001` and so on, each a full copy; appends go to the newest one.
A snapshot counts once Spark has put its success marker, so a reader or a
restarted job never sees half of one. One writer per table.
"""

import uuid
from datetime import datetime, timezone

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from auditloom import fixed
from auditloom.operators.joins import folded
from auditloom.sources.files import file_system  # noqa: F401
from auditloom.sources.jobtable import KEY, JobTable
from auditloom.sources.results import PartlyDone, ResultTable  # noqa: F401


def path_exists(spark, path):
    fs, hadoop = file_system(spark, path)
    return fs.exists(hadoop)


def _snapshots(spark, path):
    fs, hadoop = file_system(spark, path)
    if not fs.exists(hadoop):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hadoop)]
    return sorted(
        int(n.split("=")[1])
        for n in names
        if n.startswith("snapshot=") and path_exists(spark, f"{path}/{n}/_SUCCESS")
    )


def _folder(path, number):
    return f"{path}/snapshot={number:08d}"


def read_table(spark, path, schema):
    """Newest snapshot; an empty frame where there is none yet."""
    done = _snapshots(spark, path)
    if not done:
        return spark.createDataFrame([], schema)
    # A partition column is read last; put the declared order back.
    columns = StructType.fromDDL(schema).names
    return spark.read.schema(schema).parquet(_folder(path, done[-1])).select(*columns)


def write_snapshot(df, path, partition_by=()):
    """Write `df` as the next snapshot; returns its number."""
    spark = df.sparkSession
    done = _snapshots(spark, path)
    number = done[-1] + 1 if done else 1
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(_folder(path, number))
    return number


def append_table(df, path, partition_by=()):
    """Append rows to the newest snapshot."""
    done = _snapshots(df.sparkSession, path)
    df.write.mode("append").partitionBy(*partition_by).parquet(
        _folder(path, done[-1] if done else 1)
    )


def new_run():
    """A run name that sorts behind all earlier ones."""
    return f"{datetime.now(timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"


def write_results(df, path, run=None, image_from_uri=False):
    """Append result rows as the run `run`; the same run again replaces what it wrote."""
    ResultTable(df.sparkSession, path, image_from_uri=image_from_uri).append(df, run or new_run())


def write_errors(df, path, run=None):
    """Append error rows as the run `run`; the same run again replaces what it wrote."""
    df.write.mode("overwrite").parquet(f"{path}/run={run or new_run()}")


def read_results(spark, path):
    return ResultTable(spark, path).read()


def read_errors(spark, path):
    if not path_exists(spark, path):
        return spark.createDataFrame([], fixed.ERROR_SCHEMA)
    columns = StructType.fromDDL(fixed.ERROR_SCHEMA).names
    return spark.read.schema(fixed.ERROR_SCHEMA + ", run string").parquet(path).select(*columns)


def read_jobs(spark, path):
    return JobTable(spark, path).read()


def write_jobs(df, path):
    """Make `df` the whole job table."""
    JobTable(df.sparkSession, path).write(df)


def change_jobs(spark, path, rows=None, gone=None, on=KEY):
    """Put rows in place of those of their key and drop others, in the partitions they lie in only."""
    JobTable(spark, path).change(rows, gone, on)


def read_inventory(spark, path):
    """Listing of live objects: gcs_uri and generation."""
    return spark.read.schema("gcs_uri string, generation bigint").parquet(path)


def write_batch(df, path, batch_id):
    """Write one micro-batch to its own folder; a repeated batch replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def newest_batches(df, keys):
    """Rows of the newest batch of each key."""
    latest = folded(df, keys, F.max("batch_id").alias("batch_id"))
    return df.join(latest, [*keys, "batch_id"], "left_semi")


def apply_delete(spark, path, uris=None, decisions=None):
    """Delete by object or by superseded (object, version); returns the row count.

    Give as many keys as there are to one call: each call writes the touched
    parts once. The count is taken before anything is put in place.
    """
    table = ResultTable(spark, path)
    if uris is not None:
        return table.delete(uris, "gcs_uri")
    return table.delete(decisions.where("delete_superseded_rows"), KEY)


def still_there(spark, path, keys, columns):
    """Those `columns` of `keys` that have result rows."""
    return ResultTable(spark, path).remaining(keys, columns)


def apply_merge(spark, path, updates, key="image_id"):
    """Merge URL columns; returns the number of updated rows.

    Nothing is put in place when no row has an update.
    """
    return ResultTable(spark, path).merge(updates, key)
