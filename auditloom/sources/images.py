"""Binary objects."""

import re

from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.sources.files import file_system

_SCHEME = r"\A[A-Za-z][A-Za-z0-9+.-]*:/+"


def scan_images(spark, glob, root):
    """Objects under `root` (one folder per bucket) with their bytes.

    Column pruning reaches this source: without `content` no bytes are read.
    """
    # Both in the form in which the file system names its own paths.
    fs, place = file_system(spark, root)
    start = re.sub(_SCHEME, "/", fs.makeQualified(place).toString()).rstrip("/") + "/"
    path = F.regexp_replace("path", _SCHEME, "/")
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select(
            F.concat(F.lit(fixed.URI_SCHEME), F.substr(path, F.length(F.lit(start)) + 1)).alias("gcs_uri"),
            "length",
            F.col("modificationTime").alias("modified_at"),
            "content",
        )
    )
