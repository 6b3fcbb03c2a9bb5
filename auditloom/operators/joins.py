"""Reduced join sides that leave a hot key on the other side splittable.

AQE splits a hot partition of a sort-merge join only when both inputs are plain
shuffles. A side that was just grouped by the join key is not: it is already
partitioned by that key and joins in place, and then one task gets all rows of
a hot key from the other side. Grouping by the key and its hash gives the same
groups under another partitioning, so the reduced rows, which are few, are
shuffled once more and the join keeps both inputs splittable.
"""

from pyspark.sql import functions as F

_SPREAD = "_spread"


def folded(df, keys, *aggregates):
    """One row per key, to be joined on `keys`."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    grouped = df.groupBy(*keys, F.xxhash64(*keys).alias(_SPREAD))
    return grouped.agg(*aggregates).drop(_SPREAD)


def unique(df, keys):
    """The distinct keys of `df`, to be joined on."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.select(*keys, F.xxhash64(*keys).alias(_SPREAD)).distinct().drop(_SPREAD)
