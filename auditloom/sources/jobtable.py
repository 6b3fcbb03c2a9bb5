"""The job table: partitioned by a hash of the object, bucketed and sorted by it.

Look-ups and upserts join on the object without an exchange of the table, since
it is read in its buckets. A change rewrites only the partitions that hold its
objects: it stages their new rows and puts them in place by dynamic partition
overwrite; all other files stay as they are. The table is entered in the
session's catalog under a name made from its path. One writer per table.
"""

import hashlib
from contextlib import contextmanager

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from auditloom import fixed
from auditloom.operators.joins import unique
from auditloom.session import shared_dir
from auditloom.sources.files import file_system

KEY = ["gcs_uri", "prompt_version_id"]
#: Partitions of a new table, and buckets, which are the tasks of a join with it.
PARTS, BUCKETS = 32, 8
_MODE = "spark.sql.sources.partitionOverwriteMode"


@contextmanager
def _overwriting(spark, mode):
    """Overwrites replace whole tables ("static") or the partitions that are written ("dynamic")."""
    before = spark.conf.get(_MODE)
    spark.conf.set(_MODE, mode)
    try:
        yield
    finally:
        spark.conf.set(_MODE, before)


class JobTable:
    """The job table at `path`; the numbers of partitions and buckets are fixed when it is made."""

    def __init__(self, spark, path, parts=PARTS, buckets=BUCKETS):
        self.spark, self.path = spark, path.rstrip("/")
        self.columns = StructType.fromDDL(fixed.JOB_SCHEMA).names
        self.name = f"jobs_{hashlib.md5(self.path.encode()).hexdigest()[:16]}"
        fs, layout = file_system(spark, f"{self.path}/_layout")
        if fs.exists(layout):
            known = spark.read.json(f"{self.path}/_layout").first()
            parts, buckets = known.parts, known.buckets
        else:
            made = spark.range(1).select(F.lit(parts).alias("parts"), F.lit(buckets).alias("buckets"))
            made.write.mode("overwrite").json(f"{self.path}/_layout")
        self.parts = parts
        spark.sql(
            f"create table if not exists {self.name} ({fixed.JOB_SCHEMA}, part int) using parquet "
            f"partitioned by (part) clustered by (gcs_uri) sorted by (gcs_uri) into {buckets} buckets "
            f"location '{self.path}' tblproperties ('parts' = '{parts}')"
        )
        # Another session may have written the folder.
        spark.catalog.recoverPartitions(self.name)
        spark.catalog.refreshTable(self.name)

    def _part(self):
        return F.pmod(F.xxhash64("gcs_uri"), F.lit(self.parts)).cast("int").alias("part")

    def read(self, parts=None):
        """All jobs, or those in some partitions."""
        rows = self.spark.table(self.name)
        rows = rows if parts is None else rows.where(F.col("part").isin(parts))
        return rows.select(*self.columns)

    def _staged(self, rows):
        """`rows` written to the shared folder, with their partition."""
        path = shared_dir(self.spark, "staged-jobs")
        rows.select(*self.columns, self._part()).write.parquet(path)
        return self.spark.read.parquet(path)

    def _put(self, staged, mode):
        with _overwriting(self.spark, mode):
            # One file a partition and bucket.
            staged.repartition("part").write.mode("overwrite").insertInto(self.name)

    def write(self, rows):
        """Make `rows` the whole table."""
        self._put(self._staged(rows), "static")

    def touched(self, *frames):
        """Partitions that hold the objects of these frames, of which there are at most `parts`."""
        found = set()
        for frame in frames:
            found |= {r.part for r in frame.select(self._part()).distinct().collect()}
        return sorted(found)

    def change(self, rows=None, gone=None, on=KEY):
        """Put `rows` in place of those of the same key and drop those with the columns `on` of `gone`."""
        frames = [f for f in (rows, gone) if f is not None]
        parts = self.touched(*frames)
        if not parts:
            return
        left = self.read(parts)
        if gone is not None:
            left = left.join(unique(gone, on), on, "left_anti")
        if rows is not None:
            left = left.join(unique(rows, KEY), KEY, "left_anti").unionByName(rows.select(*self.columns))
        staged = self._staged(left.select(*self.columns))
        held = {r.part for r in staged.select("part").distinct().collect()}
        self._put(staged, "dynamic")
        for part in set(parts) - held:
            # A partition without rows is not written by the dynamic overwrite.
            none = self.spark.createDataFrame([], fixed.JOB_SCHEMA)
            none.createOrReplaceTempView("_no_jobs")
            self.spark.sql(f"insert overwrite table {self.name} partition (part = {part}) select * from _no_jobs")
