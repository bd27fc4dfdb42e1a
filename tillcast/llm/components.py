"""Connected components of a link table, in DataFrame operations."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.session import cut_lineage


def _large_star(links: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the node's smallest neighbour."""
    both = links.union(links.select("b", "a")).toDF("node", "near")
    least = both.groupBy("node").agg(F.min("near").alias("low"))
    low = F.least("low", "node")
    return both.join(least, "node").filter("near > node").select(F.col("near").alias("a"), low.alias("b")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them."""
    least = links.groupBy("a").agg(F.min("b").alias("low"))
    moved = links.join(least, "a").filter("b > low").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least).distinct()


def components(links: DataFrame) -> DataFrame:
    """(a, b) links of long ids -> (node, component): the smallest id that each linked node can reach,
    except for the smallest ids themselves. Alternates large and small stars until nothing moves; a node
    with many links is combined map-side, and the rounds grow with the logarithm of the longest chain."""
    high, low = F.greatest("a", "b"), F.least("a", "b")
    links = cut_lineage(links.filter("a <> b").select(high.alias("a"), low.alias("b")).distinct())
    before = None
    while True:
        sign = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if sign == before or not sign[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
        before = sign
        links = cut_lineage(_small_star(_large_star(links)))
