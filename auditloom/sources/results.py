"""The result table: Parquet in folders by run and by a hash of the image.

Rows of image `i` lie in the folder `part` = hash(i) mod `parts` of their run.
An append replaces its own run, so one that is repeated leaves no second copy.
Changes find the parts of their keys by the same hash, read only those
(a partition filter), count what they touch by the key columns, write the folders
with touched rows once, beside the table, and rename them into place. The keys are
taken some parts at a time, few enough to be broadcast, so rows that stay are
neither shuffled nor sorted. A folder that ends without rows is removed. One
application writes a table. A change that breaks off while folders are put in
place raises `PartlyDone`; repeating it completes it.
"""

import threading
import uuid
from collections import defaultdict

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from auditloom import fixed
from auditloom.functions import objects
from auditloom.operators import conform, mutate
from auditloom.operators.joins import folded, unique
from auditloom.session import shared_dir
from auditloom.sources.files import file_system

#: Parts of a new table. A part is what the change of one row rewrites in each run.
PARTS = 32
#: Keys of a change that are broadcast at a time. A single part with more is joined by a shuffle.
BROADCAST_KEYS = 100_000
_PLACE = ["run", "part"]
# Queries of one application take turns in changing a table.
_WRITING = defaultdict(threading.RLock)
_PLACE_FIELDS = [StructField("run", StringType()), StructField("part", IntegerType())]


class PartlyDone(RuntimeError):
    """Some folders have been replaced already when a change failed."""


class ResultTable:
    """The result table at `path`.

    `parts` and `image_from_uri` are properties of the table, fixed by its first
    append. With `image_from_uri` the image id of each row must be the one of its
    URI, which appends check; then keys of objects lead to their parts without a
    look at the table. Otherwise their parts are looked up in the URI column.
    """

    def __init__(self, spark, path, parts=PARTS, image_from_uri=False):
        self.spark, self.path = spark, path.rstrip("/")
        self.schema = StructType.fromDDL(fixed.RESULT_SCHEMA)
        self.parts, self.image_from_uri = parts, image_from_uri
        if self._exists(f"{self.path}/_layout"):
            known = spark.read.json(f"{self.path}/_layout").first()
            self.parts, self.image_from_uri = known.parts, known.image_from_uri

    def _exists(self, path):
        fs, place = file_system(self.spark, path)
        return fs.exists(place)

    def _part(self, image):
        return F.pmod(F.xxhash64(image), F.lit(self.parts)).cast("int")

    def rows(self, parts=None):
        """All rows with `run` and `part`, or those of some parts."""
        names = [*self.schema.names, *_PLACE]
        if not any(self._runs()):
            empty = self.spark.createDataFrame([], f"{fixed.RESULT_SCHEMA}, run string, part int")
            return empty.select(*names)
        schema = StructType([*self.schema.fields, *_PLACE_FIELDS])
        found = self.spark.read.schema(schema).parquet(self.path).select(*names)
        return found if parts is None else found.where(F.col("part").isin(parts))

    def _runs(self):
        fs, place = file_system(self.spark, self.path)
        return [s.getPath() for s in fs.listStatus(place) if s.getPath().getName().startswith("run=")] if fs.exists(place) else []

    def read(self):
        """The rows; of an object and version that several runs hold, those of the last run by name."""
        rows = self.rows()
        if len(self._runs()) > 1:
            keys = [F.coalesce(c, F.lit("")).alias(f"_{c}") for c in ("gcs_uri", "prompt_version_id")]
            named = [f"_{c}" for c in ("gcs_uri", "prompt_version_id")]
            newest = folded(rows.select(*keys, "run"), named, F.max("run").alias("run"))
            rows = rows.select("*", *keys).join(newest, [*named, "run"], "left_semi")
        return rows.select(*self.schema.names)

    def append(self, rows, run):
        """Put `rows` as the run `run`, in place of what it held before.

        Refused before anything is published: columns that are not declared, other
        types than declared, rows over the size limit, and image ids that are not
        those of the URI where the table relies on that. Absent columns are null.
        """
        declared = {f.name: f.dataType for f in self.schema.fields}
        for field in rows.schema.fields:
            if field.name not in declared:
                raise ValueError(f"Unknown column: {field.name}")
            if field.dataType != declared[field.name]:
                raise ValueError(f"Column {field.name} is {field.dataType.simpleString()}, not {declared[field.name].simpleString()}")
        whole = mutate.evolve(rows, self.schema).select(*self.schema.names)
        image = objects.image_id(F.col("gcs_uri"))
        wrong = ~F.col("image_id").eqNullSafe(image) if self.image_from_uri else F.lit(False)
        part = (
            F.when(conform.row_bytes(whole) > fixed.MAX_ROW_BYTES, F.raise_error(F.lit("Row too large")))
            .when(wrong, F.raise_error(F.concat(F.lit("Image id is not that of "), F.col("gcs_uri"))))
            .otherwise(self._part("image_id"))
        )
        if not self._exists(f"{self.path}/_layout"):
            layout = self.spark.range(1).select(F.lit(self.parts).alias("parts"), F.lit(self.image_from_uri).alias("image_from_uri"))
            layout.write.mode("overwrite").json(f"{self.path}/_layout")
        # The rebalance merges small outputs and splits large ones, also of one hot image.
        placed = whole.withColumn("part", part.cast("int")).hint("rebalance", "part")
        with _WRITING[self.path]:
            placed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("part").parquet(
                f"{self.path}/run={run}"
            )

    def parts_of(self, keys, column):
        """Numbers of the parts in which rows of `keys` can be."""
        if column == "image_id":
            found = keys.select(self._part("image_id").alias("part"))
        elif self.image_from_uri:
            found = keys.select(self._part(objects.image_id(F.col(column))).alias("part"))
        else:
            found = self.rows().select(column, "part").join(unique(keys, column), column, "left_semi").select("part")
        return sorted(r.part for r in found.distinct().collect())

    def remaining(self, keys, columns):
        """Those `columns` of `keys` that still have rows."""
        columns = [columns] if isinstance(columns, str) else columns
        rows = self.rows(self.parts_of(keys, "gcs_uri"))
        return unique(keys, columns).join(unique(rows, columns), columns, "left_semi")

    def _placed(self, keys, column):
        """`keys` with the numbers of the parts in which their rows can be, worked out once."""
        if column == "image_id":
            found = keys.withColumn("part", self._part("image_id"))
        elif self.image_from_uri:
            found = keys.withColumn("part", self._part(objects.image_id(F.col(column))))
        else:
            path = shared_dir(self.spark, "wanted")
            keys.write.parquet(path)
            keys = self.spark.read.parquet(path)
            held = self.rows().select(column, "part").join(unique(keys, column), column, "left_semi")
            found = keys.join(unique(held, [column, "part"]), column)
        path = shared_dir(self.spark, "keys")
        found.write.parquet(path)
        return self.spark.read.parquet(path)

    def change(self, keys, columns, column, rewrite=None):
        """Replace the rows with the `columns` of `keys` by `rewrite(rows, keys)`, or drop them; their number.

        `rows` and `keys` of a call of `rewrite` are those of some parts; other rows
        it leaves as they are. `column` leads from a key to its parts.
        """
        keys = self._placed(keys, column)
        beside = f"{self.path}/_staged-{uuid.uuid4().hex}"
        total, changed, emptied = 0, [], []
        for parts, few in self._groups(keys):
            some = keys.where(F.col("part").isin(parts))
            some = F.broadcast(some) if few else some
            rows = self.rows(parts)
            hits = some.select(*columns, "part", F.lit(True).alias("_hit"))
            # One row a folder of these parts.
            met = (
                rows.select(*_PLACE, *columns)
                .join(hits, [*columns, "part"], "left")
                .groupBy(*_PLACE)
                .agg(F.count("*").alias("n"), F.count("_hit").alias("hit"))
            ).where("hit > 0").collect()
            total += sum(r.hit for r in met)
            gone = [(r.run, r.part) for r in met if rewrite is None and r.hit == r.n]
            left = [(r.run, r.part) for r in met if (r.run, r.part) not in set(gone)]
            if left:
                rows = rows.where(F.struct(*_PLACE).isin([F.struct(F.lit(a), F.lit(b)) for a, b in left]))
                after = rewrite(rows, some) if rewrite else rows.join(some, [*columns, "part"], "left_anti")
                after = after.select(*self.schema.names, *_PLACE)
                # Rows joined where they lie come out folder by folder as they went in.
                after = after if few else after.hint("rebalance", *_PLACE)
                after.write.mode("append").partitionBy(*_PLACE).parquet(beside)
            changed += left
            emptied += gone
        try:
            for run, part in changed:
                self._put(f"{beside}/run={run}/part={part}", f"run={run}/part={part}", beside)
            for run, part in emptied:
                fs, place = file_system(self.spark, f"{self.path}/run={run}/part={part}")
                fs.delete(place, True)
            if changed:
                fs, place = file_system(self.spark, beside)
                fs.delete(place, True)
        except Exception as problem:
            raise PartlyDone(str(problem)) from problem
        return total

    def _groups(self, keys):
        """Lists of parts with at most `BROADCAST_KEYS` keys together, and parts with more; whether it is the former."""
        groups, held = [], 0
        # One row a part.
        for r in keys.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():
            if not groups or held + r.n > BROADCAST_KEYS:
                groups.append(([], r.n <= BROADCAST_KEYS))
                held = 0
            groups[-1][0].append(r.part)
            held += r.n
        return groups

    def _put(self, new, folder, beside):
        """Rename `new` to `folder` of the table; what stood there waits beside and comes back if that fails."""
        fs, new = file_system(self.spark, new)
        _, place = file_system(self.spark, f"{self.path}/{folder}")
        _, old = file_system(self.spark, f"{beside}/_old/{folder}")
        fs.mkdirs(old.getParent())
        if not fs.rename(place, old):
            raise OSError(f"{folder} could not be put aside.")
        done = False
        try:
            done = fs.rename(new, place)
        finally:
            if not done:
                fs.rename(old, place)
        if not done:
            raise OSError(f"{folder} could not be put in place.")

    def delete(self, keys, columns):
        """Delete all rows with the `columns` of a row of `keys`; their number."""
        columns = [columns] if isinstance(columns, str) else columns
        with _WRITING[self.path]:
            return self.change(unique(keys, sorted({"gcs_uri", *columns})), columns, "gcs_uri")

    def merge(self, updates, key):
        """Put the URL columns of `updates` into the rows of their key; the number of matched rows."""
        updates = updates.select(key, *mutate.URL_COLUMNS)
        with _WRITING[self.path]:
            return self.change(updates, [key], key, lambda rows, new: mutate.merge_urls(rows, new, [key, "part"]))
