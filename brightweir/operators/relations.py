"""Vendor relations over the canonical organisation name."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from brightweir.operators.connected import written
from brightweir.operators.lookup import key_counts, spread_lookup

# Edges of one node that stay together when a frontier meets them.
EDGES_PER_PART = 10_000


def vendor_edges(startups: DataFrame, products: DataFrame, jobs: DataFrame | None = None) -> DataFrame:
    """Edges ``(vendor, relation, target, weight)``.

    ``PRODUCES`` links a vendor to each of its products, ``HIRES`` to each role
    family it has postings for.  Both sides are brought to one row per edge
    before they meet, so that a vendor with very many records on both sides
    never multiplies them.
    """
    vendors = startups.select(F.col("entity_name").alias("vendor")).distinct()
    made = products.groupBy(F.col("startup_name").alias("vendor"), F.col("source_url").alias("target")).agg(
        F.count(F.lit(1)).alias("weight")
    )
    edges = made.withColumn("relation", F.lit("PRODUCES"))
    if jobs is not None:
        hired = jobs.groupBy(F.col("company").alias("vendor"), F.col("role_family").alias("target")).agg(
            F.count(F.lit(1)).alias("weight")
        )
        edges = edges.unionByName(hired.withColumn("relation", F.lit("HIRES")))
    # A vendor may own a large share of all edges.
    known = key_counts(edges, "vendor").join(vendors, "vendor").withColumn("is_vendor", F.lit(True))
    kept = spread_lookup(edges, known, "vendor", ["relation", "target"]).where("is_vendor")
    return kept.select("vendor", "relation", "target", "weight")


def vendor_summary(edges: DataFrame) -> DataFrame:
    """Targets and records per vendor and relation."""
    return edges.groupBy("vendor", "relation").agg(
        F.count(F.lit(1)).alias("n_targets"), F.sum("weight").alias("n_records")
    )


def both_ways(edges: DataFrame, relations: list[str]) -> DataFrame:
    """Directed steps ``src``, ``dst`` along vendor edges; those of ``relations`` can be walked back as well.

    Nodes are named by their kind, so that a vendor and a target of one name stay apart.
    """
    vendor, target = F.concat(F.lit("vendor:"), "vendor"), F.concat(F.lower("relation"), F.lit(":"), "target")
    there = edges.select(vendor.alias("src"), target.alias("dst"))
    back = edges.where(F.col("relation").isin(relations)).select(target.alias("src"), vendor.alias("dst"))
    return there.union(back).where("src is not null and dst is not null").distinct()


def reach(steps: DataFrame, starts: DataFrame, max_hops: int) -> DataFrame:
    """Every node that can be reached in at most ``max_hops`` steps: ``start, node, hops, n_paths``.

    ``steps`` has ``src`` and ``dst``, ``starts`` a column ``node``.  ``hops``
    is the least number of steps and ``n_paths`` how many ways of that length
    there are.  Each hop joins the nodes found by the last one with their steps,
    adds up the ways, and leaves out what has been visited; every hop is a
    written table.  The steps of a node with many of them are dealt to parts,
    and what reaches such a node is repeated once per part, so neither
    side of the join gathers in one task.  Repeated starts count once; a start is not
    reached by itself, and cycles end where they meet what was visited.
    """
    steps = steps.where("src is not null and dst is not null").select("src", "dst").distinct()
    parts = F.ceil(F.count(F.lit(1)) / EDGES_PER_PART).cast("int")
    degrees = written(steps.groupBy("src").agg(parts.alias("parts")), "degrees")
    dealt = spread_steps(steps, degrees)
    visited = starts.where("node is not null").select(F.col("node").alias("start"), "node").distinct()
    visited = written(visited.select("start", "node", F.lit(0).alias("hops"), F.lit(1).cast("bigint").alias("n_paths")), "reached")
    frontier, found = visited, []
    for hop in range(1, max_hops + 1):
        asked = frontier.join(degrees.withColumnRenamed("src", "node"), "node").select(
            "start", "node", "n_paths", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
        )
        met = asked.join(dealt, (asked["node"] == dealt["src"]) & (asked["part"] == dealt["in_part"]))
        ways = met.groupBy("start", F.col("dst").alias("node")).agg(F.sum("n_paths").alias("n_paths"))
        new = ways.join(visited.select("start", "node"), ["start", "node"], "left_anti")
        frontier = written(new.select("start", "node", F.lit(hop).alias("hops"), "n_paths"), "reached")
        if frontier.limit(1).count() == 0:
            break
        found.append(frontier)
        visited = visited.union(frontier)
    if not found:
        return visited.where("hops > 0")
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def spread_steps(steps: DataFrame, degrees: DataFrame) -> DataFrame:
    """Steps with the part they are dealt to, ``in_part``."""
    many = degrees.where("parts > 1")
    joined = steps.join(many, "src", "left")
    part = F.pmod(F.xxhash64("dst"), F.coalesce("parts", F.lit(1))).cast("int")
    return written(joined.select("src", "dst", part.alias("in_part")), "steps")
