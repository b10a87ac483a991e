"""Connected components over a table of links, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brightledger.session import materialise

#: A node with more links than this and than a thousandth of all links is spread over several partitions in joins.
HUB_LINKS = 50_000
HUB_SHARE = 0.001
HUB_SALTS = 64


def _with_low(links: DataFrame, low: DataFrame, n_links: int) -> DataFrame:
    """Attach ``m`` (of ``low``) to every link by ``u``; the links of hub nodes meet it in several partitions.

    There are fewer than ``1 / HUB_SHARE`` hubs, so the broadcast list of them is bounded.
    """
    floor = max(HUB_LINKS, int(n_links * HUB_SHARE))
    if n_links <= floor:
        return links.join(low.select("u", "m"), "u")
    hubs = F.broadcast(low.filter(F.col("n") > floor).select("u", F.lit(HUB_SALTS).alias("_salts")))
    salts = F.coalesce("_salts", F.lit(1))
    left = links.join(hubs, "u", "left").withColumn("_salt", F.pmod(F.xxhash64("v"), salts).cast("int")).drop("_salts")
    right = low.select("u", "m").join(hubs, "u", "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return left.join(right, ["u", "_salt"]).drop("_salt")


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b; any one orderable type); root is the smallest node reachable.

    Every node's larger neighbours are linked to its smallest neighbour, then every node to its smallest smaller
    neighbour, until all links form stars: a logarithmic number of rounds. A round is written under
    ``spark.checkpoint.dir``, so a lost executor repeats one round at most; no neighbour list is ever gathered.
    Links with a null end or from a node to itself count as absent.
    """
    state = materialise(links.filter("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")

    def digest(df):
        return df.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()

    before = digest(state)
    while before["n"]:
        both = state.union(state.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"), F.count("*").alias("n"))
        large = _with_low(both, low, before["n"]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large, "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = _with_low(large, low, before["n"]).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        state = materialise(small.union(low.select("u", "m")).distinct(), "links")
        now = digest(state)
        if now == before:
            break
        before = now
    ends = state.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    roots = state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return ends.unionByName(roots)
