"""Session settings and the shared scratch folder."""

import re
import sys
import tempfile
import uuid

from pyspark import cloudpickle

SETTINGS = {
    # Timestamps without a zone are UTC.
    "spark.sql.session.timeZone": "UTC",
    # A repeated JSON key keeps its last value instead of failing the document.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A repeated map key keeps its last value.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Runtime re-planning: small sides found at run time become broadcasts,
    # small partitions are merged, hot join partitions are split.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A table bucketed by the object also joins on (object, version) as it lies.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A task writes rows of a few folders as they come, without a sort by folder.
    "spark.sql.maxConcurrentOutputFileWriters": "32",
    # Bounds the grouping state a failed streaming task has to rebuild.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def prepare(spark):
    """Apply the settings the operators rely on; returns the session.

    The few functions that run in Python workers travel by value, so executors
    do not need this package installed.
    """
    cloudpickle.register_pickle_by_value(sys.modules["auditloom"])
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


_LOCAL_ROOT = []


def shared_dir(spark, purpose):
    """A new folder name for `purpose` under the cluster's shared checkpoint folder.

    A local session that names none gets a temporary folder; on a cluster that
    is an error, since executors would not share it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "local")):
            raise ValueError("Set spark.checkpoint.dir to a folder all executors share.")
        if not _LOCAL_ROOT:
            _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
        root = _LOCAL_ROOT[0]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
