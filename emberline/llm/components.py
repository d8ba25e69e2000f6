"""Steps that store their results, and connected components made of them; no graph reaches the driver."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberline.session import scratch_path


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again, so that a lost executor costs no more than one step."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def frees_shuffles(operator: Callable) -> Callable:
    """Within an operator of stored steps, let Spark delete a query's shuffle files when the query ends.

    Batches for Python are kept small too: a row is a whole text.
    """
    settings = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
                "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}

    @wraps(operator)
    def run(docs: DataFrame, *args, **options):
        conf = docs.sparkSession.conf
        before = {name: conf.get(name) for name in settings}
        try:
            for name, value in settings.items():
                conf.set(name, value)
            return operator(docs, *args, **options)
        finally:
            for name, value in before.items():
                conf.set(name, value)

    return run


def small_batches(spark: SparkSession) -> None:
    """For sessions that run these operators: a row is a whole text, so few of them make a batch for Python."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of (a, b) edges; the root is the least node reachable.

    Each step takes the least root around a node, then the root of that root, until none changes.
    """
    pairs = edges.filter("a <> b").select("a", "b")
    both = stored(pairs.union(pairs.select("b", "a")).distinct(), "edges")
    roots = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("root")), "roots")
    while True:
        around = both.join(roots, both.b == roots.node).groupBy("a").agg(F.min("root").alias("near"))
        nearer = roots.join(around, roots.node == around.a).select("node", F.least("root", "near").alias("new"), "root")
        nearer = stored(nearer, "nearer")
        jumped = nearer.alias("n").join(nearer.alias("r"), F.col("n.new") == F.col("r.node")).select(
            "n.node", F.least("n.new", "r.new").alias("root"), (F.least("n.new", "r.new") < F.col("n.root")).alias("moved"))
        jumped = stored(jumped, "roots")
        roots = jumped.select("node", "root")
        if not jumped.filter("moved").limit(1).count():
            return roots
