"""River networks as edge tables (id, next_down); 0 stands for no downstream basin."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alluvia.sources.staging import staged


def upstream_closure(edges: DataFrame, starts: DataFrame | None = None) -> DataFrame:
    """basin and upstream for every start (all ids by default), itself included; cycles end, as visited pairs aren't revisited.

    Each round joins the frontier to the edges and is written, so that plans stay short; rounds are the longest path. The
    result holds every pair: ask for the starts that are needed, and use upstream_counts() where only numbers are.
    """
    edges = staged(edges.select("id", "next_down"), "edges")
    frontier = staged((edges if starts is None else starts).select(F.col("id").alias("basin"), F.col("id").alias("upstream")).distinct(), "frontier")
    seen = frontier
    up = edges.where("next_down <> 0").select(F.col("next_down").alias("upstream"), F.col("id").alias("next"))
    while not frontier.isEmpty():
        found = frontier.join(up, "upstream").select("basin", F.col("next").alias("upstream"))
        frontier = staged(found.join(seen, ["basin", "upstream"], "left_anti").distinct(), "frontier")
        seen = seen.unionByName(frontier)
    return seen


def upstream_sums(edges: DataFrame, weight: str | None = None) -> DataFrame:
    """id and total of the weights (1 each by default) of a basin and all upstream of it, without listing pairs.

    After round k a basin has the sum over its basins less than 2**k steps upstream; those at exactly so many steps hand theirs
    to it. Rounds are the logarithm of the longest path, each over one row a basin. Basins of a cycle, which no round ends,
    are added up over their closure.
    """
    own = F.lit(1).cast("long") if weight is None else F.col(weight)
    edges = staged(edges.select("id", F.when(F.col("next_down") != 0, F.col("next_down")).alias("next_down"), own.alias("w")), "edges")
    ids = edges.select(F.col("id").alias("next_down"))
    inside = edges.where("next_down IS NOT NULL").join(ids, "next_down", "left_semi").select("id", F.col("next_down").alias("far"))
    state = staged(edges.select("id", F.col("w").alias("total")).join(inside, "id", "left"), "sums")
    for _ in range(max(1, math.ceil(math.log2(max(2, edges.count())))) + 1):
        if state.where("far IS NOT NULL").isEmpty():
            return state.select("id", "total")
        handed = state.where("far IS NOT NULL").groupBy(F.col("far").alias("id")).agg(F.sum("total").alias("more"))
        farther = state.select(F.col("id").alias("far"), F.col("far").alias("next"))
        state = state.join(farther, "far", "left").join(handed, "id", "left")
        state = staged(state.select("id", (F.col("total") + F.coalesce("more", F.lit(0))).alias("total"), F.col("next").alias("far")), "sums")
    round_ = staged(state.where("far IS NOT NULL").select(F.col("far").alias("id")).distinct(), "cycles")
    again = upstream_closure(edges.select("id", F.coalesce("next_down", F.lit(0)).alias("next_down")), round_).join(edges.select(F.col("id").alias("upstream"), "w"), "upstream").groupBy(F.col("basin").alias("id")).agg(F.sum("w").alias("total"))
    return state.join(round_, "id", "left_anti").select("id", "total").unionByName(again)


def upstream_counts(edges: DataFrame) -> DataFrame:
    """basin, n_upstream without itself, and headwater."""
    return upstream_sums(edges).select(F.col("id").alias("basin"), (F.col("total") - 1).alias("n_upstream"), (F.col("total") == 1).alias("headwater"))


def kept_edges(edges: DataFrame, kept: DataFrame) -> DataFrame:
    """Edges among kept ids: a kept id whose downstream basin isn't kept is an outlet."""
    own = edges.join(kept.select("id"), "id", "left_semi")
    down = kept.select(F.col("id").alias("next_down"), F.lit(True).alias("__kept"))
    return own.join(down, "next_down", "left").select("id", F.when(F.col("__kept"), F.col("next_down")).otherwise(0).alias("next_down"))


def with_geometry(closure: DataFrame, basins: DataFrame) -> DataFrame:
    """Pairs of a closure with the upstream basin's columns; basins that the table lacks are dropped."""
    return closure.join(basins.withColumnRenamed("id", "upstream"), "upstream")


def downstream_paths(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """basin, step and place: the way down from each start until there is no downstream basin or the way closes."""
    edges = staged(edges.select("id", "next_down"), "edges")
    frontier = staged(starts.select(F.col("id").alias("basin"), F.lit(0).alias("step"), F.col("id").alias("place")), "path")
    seen = frontier
    step = edges.where("next_down <> 0").withColumnRenamed("id", "place")
    while not frontier.isEmpty():
        moved = frontier.join(step, "place").select("basin", (F.col("step") + 1).alias("step"), F.col("next_down").alias("place"))
        frontier = staged(moved.join(seen, ["basin", "place"], "left_anti"), "path")
        seen = seen.unionByName(frontier)
    return seen


def pour_points(fragments: DataFrame, least: float = 0.5) -> DataFrame:
    """basin and place: where the water of each basin's fragments (basin, id, next_down, overlap, area) gathers, and place's feeders.

    The walk begins at the fragment of most overlap (ties: the least id) and goes down while the next fragment is one of the
    basin's and overlaps it by at least a share of its area. One row for the last place (feeder false) and one for each of the
    basin's fragments that drain into it (feeder true). All basins walk together, one step a round.
    """
    f = staged(fragments.select("basin", "id", "next_down", "overlap", "area"), "fragments")
    start = f.groupBy("basin").agg(F.max_by("id", F.struct("overlap", -F.col("id"))).alias("place"))
    good = f.where(F.col("overlap") >= least * F.col("area")).select("basin", F.col("id").alias("next"))
    steps = staged(f.select("basin", F.col("id").alias("place"), F.col("next_down").alias("next")).where("next <> 0").join(good, ["basin", "next"], "left_semi").select("basin", "place", "next"), "steps")
    at = staged(start, "walk")
    seen = at
    ended = None
    while True:
        moved = staged(at.join(steps, ["basin", "place"], "left").select("basin", "place", "next"), "walk")
        stop = moved.where("next IS NULL").select("basin", "place")
        ended = stop if ended is None else ended.unionByName(stop)
        on = moved.where("next IS NOT NULL").select("basin", F.col("next").alias("place"))
        closed = on.join(seen, ["basin", "place"], "left_semi")  # a cycle ends where it closes
        ended = ended.unionByName(closed)
        at = staged(on.join(seen, ["basin", "place"], "left_anti"), "walk")
        if at.isEmpty():
            break
        seen = seen.unionByName(at)
    ended = staged(ended, "ends")
    feeders = f.select("basin", F.col("id").alias("feeder_id"), F.col("next_down").alias("place")).join(ended, ["basin", "place"]).select("basin", F.col("feeder_id").alias("place"), F.lit(True).alias("feeder"))
    return ended.withColumn("feeder", F.lit(False)).unionByName(feeders)


def referential_counts(edges: DataFrame) -> DataFrame:
    """Outlets, ids whose downstream basin is there, ids whose downstream basin is missing, and the share of the former among the latter two in per cent."""
    ids = edges.select(F.col("id").alias("next_down"), F.lit(1).alias("there"))
    inside, missing = F.count_if(F.col("there") == 1), F.count_if((F.col("next_down") != 0) & F.col("there").isNull())
    return edges.join(ids, "next_down", "left").agg(
        F.count_if(F.col("next_down") == 0).alias("n_outlets"), inside.alias("n_inside"), missing.alias("n_missing"), F.try_divide(inside * 100.0, inside + missing).alias("inside_percentage"),
    )
