"""From buckets of possible partners to verified links and their connected components, without all pairs of large buckets."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alluvia.llm.storage import materialise

SMALL = 32
PAIR_ROWS = 400


def _pairs_within(entries: DataFrame) -> DataFrame:
    """All pairs a < b of buckets with at most SMALL entries, but those that a common label shows to be linked already."""
    lists = entries.groupBy("bucket").agg(F.collect_set(F.struct("id", "label")).alias("all"))
    first = lists.select("all", F.explode("all").alias("x"))
    others = F.filter("all", lambda y: (y["id"] > F.col("x.id")) & ~F.coalesce(y["label"] == F.col("x.label"), F.lit(False)))
    return first.select(F.col("x.id").alias("a"), F.explode(F.transform(others, lambda y: y["id"])).alias("b"))


def bucket_pairs(entries: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs to verify of small buckets, and the stars of large ones (bucket, band, a: leader, b: member, label, leader_label).

    entries: bucket, band, id and label. All entries of a bucket have one band, the place of the key that made it; entries of
    the same label, if it isn't null, are known to be connected. Buckets of at most SMALL entries give all their pairs. In a
    larger one every member is paired with the leader, the member that meets most others over all its buckets (ties: the least
    id): the centre of a group of near copies. A count by bucket is joined back, so that no task holds a large bucket.
    """
    sizes = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    sized = materialise(entries.join(sizes, "bucket"), "buckets")
    small = _pairs_within(sized.where(F.col("n") <= SMALL))
    large = sized.where(F.col("n") > SMALL)
    weight = large.groupBy("id").agg(F.sum("n").alias("weight"))
    leaders = large.join(weight, "id").groupBy("bucket").agg(F.max_by(F.struct(F.col("id").alias("leader"), F.col("label").alias("leader_label")), F.struct("weight", -F.col("id"))).alias("x"))
    stars = large.join(leaders.select("bucket", "x.*"), "bucket").where("id != leader")
    return small, stars.select("bucket", "band", F.col("leader").alias("a"), F.col("id").alias("b"), "label", "leader_label")


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified_links(entries: DataFrame, verify: Callable[[DataFrame], DataFrame], refine: Callable[[DataFrame, int], DataFrame | None], remainder: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The links (a, b) among the members of buckets (bucket, band, id) that verify() keeps.

    Where a member of a large bucket doesn't link to the leader, the bucket's members go on to the narrower buckets that
    refine(entries, level) gives, level by level; there, pairs that one leader connects already are left out. When it gives
    None, remainder(entries) gives the links of the rest, by default a full join that Spark can split.
    """
    links, level = None, 0
    entries = entries.distinct().withColumn("label", F.lit(None).cast("long"))
    apart = ~F.coalesce(F.col("label") == F.col("leader_label"), F.lit(False))
    while True:
        small, stars = bucket_pairs(entries)
        stars = materialise(stars, "stars")
        found = materialise(verify(_ordered(small.unionByName(stars.where(apart).select("a", "b")))), "links", PAIR_ROWS).select("a", "b")
        links = found if links is None else links.unionByName(found)
        if stars.isEmpty():
            break
        both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().withColumn("linked", F.lit(True))
        judged = stars.join(both, ["a", "b"], "left").withColumn("linked", F.coalesce("linked", ~apart))
        judged = materialise(judged, "judged")
        open_ = judged.where(~F.col("linked")).select("bucket").distinct()
        label = F.coalesce("label", F.when(F.col("linked"), F.coalesce("leader_label", "a")))
        rest = judged.join(open_, "bucket", "left_semi").select("bucket", "band", F.col("b").alias("id"), label.alias("label"))
        rest = materialise(rest, "rest")
        if rest.isEmpty():
            break
        level += 1
        entries = refine(rest, level)
        if entries is None and remainder:
            links = links.unionByName(materialise(remainder(rest), "links", PAIR_ROWS).select("a", "b"))
            break
        if entries is None:
            x, y = (rest.select("bucket", F.col("id").alias(k), F.col("label").alias(f"l{k}")) for k in "ab")
            left = x.join(y, "bucket").where((F.col("a") < F.col("b")) & ~F.coalesce(F.col("la") == F.col("lb"), F.lit(False))).select("a", "b").distinct()
            links = links.unionByName(materialise(verify(left), "links", PAIR_ROWS).select("a", "b"))
            break
    return links.distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """id and root, the least id of its component, of all ids in links (a, b): alternating large and small stars.

    Each round is written to the shared folder; rounds grow with the logarithm of the longest path. A hub's neighbours are
    never gathered: its least neighbour is aggregated and joined back.
    """
    edges = materialise(links.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
        before = state
        around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        large = around.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        below = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(below, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = materialise(small.unionByName(below.select("a", F.col("m").alias("b"))).distinct(), "edges")
