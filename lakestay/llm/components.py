"""Connected components of a graph of any size, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestay.session import delete_folder, work_folder


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared work folder, so that nothing before it runs again."""
    return _stored(df, label)[0]


def _stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    path = work_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node with an edge, root the smallest node it is connected with.

    edges has two bigint columns, a and b, in any order; loops and repeated edges are
    allowed, edges with a null end are ignored. Large-star and small-star steps alternate
    until nothing changes: every node hangs on the smallest node it knows of, first with its
    larger neighbours, then with its smaller ones. The rounds needed grow with the logarithm
    of the graph. Minima are combined map-side, then joined back to the edges; only there do the
    edges of one node meet, two numbers each. Of the rounds' tables only the last one stays.
    """
    now, path = _stored(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    state = None
    while True:
        # Of pairs (u, v) with v < u, seen from both ends.
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        spent = path
        now, path = _stored(moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        last, state = state, now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        delete_folder(now.sparkSession, spent)
        if state == last:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
