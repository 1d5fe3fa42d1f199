"""Links inside candidate buckets and their connected components, with DataFrame operations only."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import delete_path, scratch_path, session_conf

#: Buckets up to this size compare their remaining pairs in one equi-join; larger ones take PIVOTS members at a time.
SMALL, PIVOTS = 256, 128
#: With more pairs than so many for each id, fine sketches of the ids cost less than comparing them all.
PAIRS_PER_ID = 2
#: At most this many ids (8 bytes each) are broadcast to filter a table.
BROADCAST_IDS = 1_000_000


def written(df: DataFrame, name: str) -> DataFrame:
    """*df* as a table in the shared scratch folder: lineage ends there, and a lost executor loses nothing."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_SCOPES: list[list[str]] = []


@contextmanager
def temporary(spark: SparkSession):
    """Tables that ``written`` makes inside the block go at its end, all but the last one: the block's result."""
    _SCOPES.append([])
    try:
        yield
    finally:
        paths = _SCOPES.pop()
        for path in paths[:-1]:
            delete_path(spark, path)
        if _SCOPES:
            _SCOPES[-1] += paths[-1:]


#: A query's shuffle files go when it ends, not when the driver's JVM next collects garbage.
CLEAN = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def written_clean(df: DataFrame, name: str) -> DataFrame:
    """As ``written``, for large steps: the shuffle files of making the table go once it is there."""
    with session_conf(df.sparkSession, CLEAN):
        return written(df, name)


def only(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of *df* whose *column* is in the table ``ids(column)`` of distinct values.

    The ids are broadcast if there are at most BROADCAST_IDS of them (a bounded
    size); more of them are joined by a shuffle.
    """
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, column, "left_semi")


def components(links: DataFrame) -> DataFrame:
    """Distributed union-find: ``(id, component)`` for every end of a link (a, b); component = smallest id reachable.

    Alternating star contraction, until every edge points from a node that is
    no centre to its only centre.  Each round lowers every edge to the smallest
    neighbour by an aggregate (combined before the shuffle) and a join, so a
    node with very many links costs no single task more than the others.
    """

    def lowered(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        return edges.join(least, "u"), least

    def is_stars(edges: DataFrame) -> bool:
        ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("id"), F.lit(1).alias("out")), F.struct(F.col("v").alias("id"), F.lit(0).alias("out")))).alias("e")).select("e.*")
        odd = ends.groupBy("id").agg(F.sum("out").alias("n_out"), F.min("out").alias("least")).filter("n_out > 1 or (n_out = 1 and least = 0)")
        return odd.isEmpty()

    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "edges")
    while not is_stars(edges):
        near, _ = lowered(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))))
        large = near.filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).filter("u > v")
        near, least = lowered(large)
        small = near.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        edges = written(small.distinct(), "edges")
    return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    )


def linked_components(members: DataFrame, sketches: DataFrame, likely: Callable[[str], Column], verify: Callable[[DataFrame], DataFrame], finer: Callable[[DataFrame], DataFrame], possible: Callable[[str], Column], fetch: Callable[[DataFrame], None]) -> DataFrame:
    """Components under all verified links between members of a common bucket.

    ``members(key, id)``: candidate buckets, each row once; ``sketches(id, ...)``:
    what is known of every id.  ``likely(prefix)`` is a condition on a
    pair inside the join, the second row's columns having *prefix*;
    ``verify(pairs(a, b))`` returns the pairs that are links.  For members of
    large buckets ``finer(ids(id))`` gives ``(id, n, fine)`` and ``possible(prefix)``
    is a further condition on a pair, with ``n`` and ``fine`` known; so it is
    where ids have more than PAIRS_PER_ID pairs on average.  Before any
    of these ``fetch(ids(id))`` gets all ids that share a bucket.  Pairs of a bucket
    are not all emitted: each member first meets the bucket's smallest and
    largest id.  Only buckets whose members are still in several components go
    on, and there only pairs across components: small buckets at once, large
    ones PIVOTS members of their smallest components at a time (a pair of
    several buckets in one of them), until every open pair was compared.  So the components are those of all candidate pairs
    that are likely, without a cap.  A round's tables go once the next are
    written.  Returns ``(id, component)`` for ids with a link.
    """
    spark = members.sparkSession
    second = lambda df, *more: df.select("key", *(F.col(c).alias(f"p_{c}") for c in [*columns, *more]))
    columns = sketches.columns
    scratch: list[str] = []

    def held(df: DataFrame, name: str) -> DataFrame:
        scratch.append(scratch_path(spark, name))
        with session_conf(spark, CLEAN):
            df.write.parquet(scratch[-1])
        return spark.read.schema(df.schema).parquet(scratch[-1])

    def drop(paths: list[str]) -> None:
        for path in paths:
            delete_path(spark, path)
            scratch.remove(path)

    def linked(pairs: DataFrame) -> DataFrame:
        open_pairs = held(pair_of(pairs.filter(likely("p_")), "id", "p_id"), "pairs")
        ids = open_pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        if open_pairs.count() > PAIRS_PER_ID * ids.count():
            fine = held(finer(ids), "pair-sketches")
            first = fine.withColumnRenamed("id", "a")
            both = open_pairs.join(first, "a").join(fine.select(F.col("id").alias("b"), F.col("n").alias("p_n"), F.col("fine").alias("p_fine")), "b")
            open_pairs = held(both.filter(possible("p_")).select("a", "b"), "pairs")
        return written_clean(verify(open_pairs), "links")

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # once, for the bounds and for the members; nearly all keys are kept apart in memory, so a task gets half the usual share
    dealt = members.repartition(2 * tasks, "key")
    bounds = dealt.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo < hi")
    # few keys are shared: they are held in memory, in place of sorting all members
    shared = held(dealt.join(bounds.hint("shuffle_hash"), "key"), "shared-keys")
    fetch(shared.select("id").distinct())
    opened = held(shared.join(sketches, "id"), "buckets")
    ends = second(opened.filter("id = lo or id = hi"))
    links = linked(opened.join(ends, "key").filter("id != p_id"))
    known = written(components(links), "components")
    opened = opened.filter("id != lo and id != hi").select("key", *columns)  # those two have met everyone
    while True:
        before = scratch[1:]  # the first is the table of shared keys
        labelled = opened.join(known, "id", "left").withColumn("label", F.coalesce("component", "id"))
        mixed = labelled.groupBy("key").agg(F.count(F.lit(1)).alias("n_members"), F.min("label").alias("x"), F.max("label").alias("y")).filter("x < y").select("key", "n_members")
        rest = held(labelled.drop("component").join(mixed, "key"), "open")
        sizes = rest.agg(F.sum((F.col("n_members") <= SMALL).cast("long")), F.sum((F.col("n_members") > SMALL).cast("long"))).first()
        if not sizes[0] and not sizes[1]:
            drop(list(scratch))
            return known
        # as many tasks as a shuffle has: there is little to read, but every member meets all others of its bucket
        few = rest.filter(F.col("n_members") <= SMALL).repartition(tasks, "key")
        pairs = few.join(second(few, "label"), "key").filter("id < p_id and label != p_label").drop("p_label")
        many = rest.filter(F.col("n_members") > SMALL)
        if sizes[1]:
            shares = many.groupBy("key", "label").agg(F.count(F.lit(1)).alias("share"))
            turn = Window.partitionBy("key").orderBy("share", "id")
            # a pair that shares several buckets is compared in the one of the least key
            ids = held(many.select("id").distinct(), "large-ids")
            keys = only(shared.select("id", "key"), ids, "id").groupBy("id").agg(F.collect_list("key").alias("keys"))
            many = held(many.join(keys.join(finer(ids), "id"), "id"), "large")
            pivots = many.join(shares, ["key", "label"]).withColumn("turn", F.row_number().over(turn)).filter(F.col("turn") <= PIVOTS)
            pivots = held(second(pivots, "label", "keys", "n", "fine"), "pivots")
            across = many.join(pivots, "key").filter("label != p_label").filter(likely("p_")).filter(possible("p_")).filter(F.col("key") == F.array_min(F.array_intersect("keys", "p_keys")))
            pairs = pairs.unionByName(across.select(pairs.columns))
            met = pivots.select(F.col("key").alias("met_key"), "p_id")
            opened = many.join(met, (many["key"] == met["met_key"]) & (many["id"] == met["p_id"]), "left_anti").select("key", *columns)
        known = joined(known, linked(pairs))
        if not sizes[1]:
            drop(list(scratch))
            return known
        drop(before)


def joined(known: DataFrame, links: DataFrame) -> DataFrame:
    """*known* components after further links: only the components that a link touches are contracted again."""
    if links.isEmpty():
        return known
    name = lambda df, end: df.join(known.select(F.col("id").alias(end), F.col("component").alias(f"c{end}")), end, "left").withColumn(f"c{end}", F.coalesce(f"c{end}", end))
    over = components(name(name(links, "a"), "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    ends = links.select(F.explode(F.array("a", "b")).alias("id")).distinct().withColumn("component", F.col("id"))
    everyone = known.unionByName(ends.join(known, "id", "left_anti"))
    lower = over.select(F.col("id").alias("component"), F.col("component").alias("lower"))
    return written(everyone.join(lower, "component", "left").select("id", F.coalesce("lower", "component").alias("component")), "components")


def pair_of(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.select(F.least(x, y).alias("a"), F.greatest(x, y).alias("b")).distinct()
