"""Connected components of a link table by alternating large-star and small-star steps.

Links are longs (u, v). Every step is a grouped minimum (combined before the
shuffle) and an equi-join of two written tables, so Spark can split a node with
very many links; nothing is collected. The number of rounds grows with the
logarithm of the node count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node that has a link; an empty table has none.

    Repeated links and links of a node with itself count for nothing more.
    """
    links = durable(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                    .where("u > v").distinct())
    before, now = None, _state(links)
    while now != before:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = durable(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        links = durable(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                        .where("u > v").distinct())
        least = durable(links.groupBy("u").agg(F.min("v").alias("m")))
        rest = links.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = durable(rest.unionByName(least.withColumnRenamed("m", "v")).distinct())
        before, now = now, _state(links)
    return durable(links.select(F.col("u").alias("node"), F.col("v").alias("component"))
                   .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
