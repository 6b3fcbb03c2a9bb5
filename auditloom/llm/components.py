"""Connected components of a link table, by labels that shrink in both ways.

Each round lowers a node's label to the smallest one among its neighbours and
then to its label's own label, so long chains collapse in a few rounds. Tables
of nodes are written to the shared folder each round, which also cuts lineage.
"""

from pyspark.sql import functions as F

from auditloom.operators.joins import folded
from auditloom.session import shared_dir


def stored(df, purpose):
    """`df` written to the shared folder and read again, its size known to the planner."""
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    df.write.parquet(path)
    return spark.read.parquet(path)


def components(links):
    """(node, label) of each node in `links` (x, y); the label is its smallest reachable node."""
    both = links.select("x", "y").union(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
    both = stored(both.filter("x <> y").distinct(), "links")
    first = folded(both.withColumnRenamed("x", "node"), "node", F.min("y").alias("low"))
    labels = stored(first.select("node", F.least("node", "low").alias("label")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("y"), "label"), "y")
        near = folded(near.withColumnRenamed("x", "node"), "node", F.min("label").alias("low"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "low").alias("low"))
        lower = stored(lower, "labels")
        jump = lower.select(F.col("node").alias("low"), F.col("low").alias("beyond"))
        after = lower.join(jump, "low").select("node", F.col("beyond").alias("new"), "label")
        after = stored(after, "labels")
        labels = after.select("node", F.col("new").alias("label"))
        if after.filter("new <> label").isEmpty():
            return labels
