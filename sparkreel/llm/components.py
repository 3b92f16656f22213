"""Connected components of a graph held as a DataFrame of links."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, remove

#: A node with more pairs than this is a hub: its pairs are dealt out in parts of about so many.
HUB = 1_000_000


def join_labels(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (the least known member of each component, for all members) after the links (a, b).

    Only roots are hooked: another node's label may be the one record of an older link.
    """
    while True:
        a, b = label[a], label[b]
        apart = a != b
        if not apart.any():
            return label
        a, b = a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != (up := label[label])).any():
            label = up


def _with_minimum(pairs: DataFrame, include_self: bool, most: int, hub: int) -> DataFrame:
    """Each pair (u, v) with m, the least neighbour of u (or u itself); ``most``: at most so many pairs.

    A node with more than ``hub`` pairs has them spread over salts in proportion to its degree, so
    that no task takes all pairs of a hub; its minimum, one row, is copied to those salts alone.
    """
    least = F.min(F.least("u", "v") if include_self else F.col("v")).alias("m")
    if most <= hub:
        return pairs.join(pairs.groupBy("u").agg(least), "u").select("u", "v", "m")
    minima = materialise(pairs.groupBy("u").agg(least, F.expr(f"(count(*) + {hub - 1}) div {hub}").alias("salts")), "minima")
    wide = minima.agg(F.max("salts")).first()[0] or 1
    plain = pairs.join(minima.where("salts = 1").select("u", "m"), "u").select("u", "v", "m")
    if wide == 1:
        return plain
    # Pairs of hubs alone are dealt by (u, salt); which salts a hub has follows from its own degree.
    salted = pairs.withColumn("draw", F.pmod(F.xxhash64("v"), F.lit(wide)))
    copies = minima.where("salts > 1").select("u", "m", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(wide - 1).cast("long"))).alias("draw"))
    return plain.unionByName(salted.join(copies, ["u", "draw"]).select("u", "v", "m"))


def connected_components(links: DataFrame, hub: int = HUB) -> DataFrame:
    """``(node, component)`` for each node of ``links(a, b)``; component is the least node reachable.

    Large-star and small-star steps in turn (Kiveris et al., 2014) until the links no longer
    change, which they do for every finite graph. Each round is written to the shared folder and the
    one before is removed; only a count and a checksum come to the driver. Self links and nulls
    count for nothing; an empty input gives an empty result.
    """
    edges = materialise(
        links.where("a is not null and b is not null and a != b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "links",
    )
    mark = F.struct(F.count("*"), F.bit_xor(F.xxhash64("u", "v")))
    last, settled = edges.agg(mark.alias("s")).first()[0], False
    while last[0] and not settled:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            _with_minimum(both, True, 2 * last[0], hub).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        small = _with_minimum(large, False, 2 * last[0], hub)
        before, edges = edges, materialise(
            small.where("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .distinct(),
            "links",
        )
        remove(before)
        now = edges.agg(mark.alias("s")).first()[0]
        last, settled = now, now == last
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def join_further(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``connected_components`` of the links behind ``roots(node, component)`` and of more ``links(a, b)``.

    The new links are drawn between the components that there are, so a component costs one node,
    however many members it has. A node that neither table holds isn't in the result.
    """
    of_a, of_b = roots.toDF("a", "in_a"), roots.toDF("b", "in_b")
    ends = links.where("a is not null and b is not null").join(of_a, "a", "left").join(of_b, "b", "left")
    between = ends.select(F.coalesce("in_a", "a").alias("a"), F.coalesce("in_b", "b").alias("b")).where("a != b").distinct()
    upper = materialise(connected_components(between), "upper")
    lower = roots.join(upper.toDF("component", "top"), "component", "left").select("node", F.coalesce("top", "component").alias("component"))
    return lower.unionByName(upper.join(roots, "node", "left_anti"))
