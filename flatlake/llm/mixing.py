"""Mixing sources by temperature: exponent search, token quotas, block permutations.

With token shares p, weights are ``p ** a`` normalised.  Lowering the exponent a
from 1 towards 0 raises both the entropy of the weights and the repetition of
small sources, so each constraint is one crossing that bisection finds.  Every
round splits the interval in SECTIONS parts at once (several bisection steps in
one aggregate over the sources), so no list of sources comes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .linking import written

SECTIONS, SEARCH_ROUNDS = 32, 4
#: Tokens of a block of the mix.
BLOCK = 1_000_000
#: A plan of at most this many sources (one narrow row each) is broadcast.
BROADCAST_SOURCES = 10_000
WORD = r"[^\x20\x09-\x0D]+"


def crossing(sources: DataFrame, ok: str) -> float:
    """Largest exponent in [0, 1] (to 32**-4) at which the SQL condition *ok* holds, from the stats of ``sources(p, reach)``.

    *ok* may use ``entropy`` (share of the largest possible) and ``repetition``
    and must hold below its crossing and fail above it.  1 if it holds there;
    0 if it holds nowhere.
    """
    lo, width = 0.0, 1.0
    for _ in range(SEARCH_ROUNDS):
        grid = F.array(*(F.lit(lo + width * i / SECTIONS) for i in range(SECTIONS + 1)))
        each = sources.select("p", "reach", F.explode(grid).alias("a"))
        stats = each.groupBy("a").agg(F.sum(F.expr("pow(p, a)")).alias("z"), F.sum(F.expr("pow(p, a) * ln(p)")).alias("m"), F.max(F.expr("pow(p, a) / reach")).alias("most"), F.count(F.lit(1)).alias("s"))
        stats = stats.selectExpr("a", "case when s > 1 then (ln(z) - a * m / z) / ln(s) else 1.0D end as entropy", "most / z as repetition")
        good = {r["a"] for r in stats.filter(ok).select("a").collect()}
        points = [lo + width * i / SECTIONS for i in range(SECTIONS + 1)]
        last = max((i for i, x in enumerate(points) if x in good), default=None)
        if last is None:
            return 0.0
        if last == SECTIONS:
            return points[-1]
        lo, width = points[last], width / SECTIONS
    return lo


def exponent(sources: DataFrame, least_entropy: float, most_repetition: float) -> float:
    """Exponent of the weights: the largest that gives the entropy, raised if a source would repeat too often."""
    for_entropy = crossing(sources, f"entropy >= {least_entropy!r}D")
    # repetition falls as the exponent rises: the crossing of its complement is the least exponent allowed
    too_often = crossing(sources, f"repetition > {most_repetition!r}D")
    if too_often > 0.0:
        too_often = min(1.0, too_often + float(SECTIONS) ** -SEARCH_ROUNDS)
    return max(for_entropy, too_often)


def mixed(
    docs: DataFrame, least_entropy: float = 0.97, most_repetition: float = 4.0, budget: int | None = None, block: int = BLOCK, seed: int = 17,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """The mix: one row per occurrence of a document: ``id_col, source, n_tokens, epoch, block, order_key``.

    Tokens are words.  *budget* tokens (default: as many as the corpus has) are
    shared out by the weights.  A source gives whole epochs and then the
    documents of one more permutation whose running token sum stays within the
    rest of its quota.  Its progress through the quota picks the block, so every
    block holds the sources by weight; inside a block the order is that of
    ``order_key``.  Running sums are taken over hash ranges first and inside
    them after, about the square root of a source's size each, so a source with
    a third of all documents fills no single task.

    Defined cases: a null source is a source named ''; a null text has no
    tokens; a source without tokens is not in the mix, other documents without
    tokens are (they cost nothing); null ids and repeated rows are occurrences of their own; an empty
    table gives an empty mix; other columns are ignored.
    """
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"),
        F.coalesce(F.expr(f"regexp_count({_quoted(text_col)}, r'{WORD}')"), F.lit(0)).cast("bigint").alias("n_tokens"),
    )
    rows = written(rows, "tokens")
    sums = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).filter("tokens > 0")
    total, n_sources = sums.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    total = int(total or 0)
    budget = total if budget is None else budget
    stats = written(sums.withColumn("p", F.col("tokens") / F.lit(max(1, total)).cast("double")).withColumn("reach", F.col("tokens") / F.lit(max(1, budget)).cast("double")), "sources")
    a = exponent(stats, least_entropy, most_repetition) if total else 1.0
    z = float(stats.agg(F.sum(F.pow("p", F.lit(a)))).first()[0] or 1.0)
    blocks = max(1, -(-budget // block))
    plan = stats.withColumn("quota", F.floor(F.pow("p", F.lit(a)) / F.lit(z) * F.lit(float(budget))).cast("bigint")).select(
        "source", "tokens", "quota", F.floor(F.col("quota") / F.col("tokens")).cast("int").alias("epochs"), F.ceil(F.sqrt("docs")).cast("bigint").alias("ranges")
    )
    if n_sources <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    rest = F.col("quota") - F.col("epochs") * F.col("tokens")
    each = rows.join(plan, "source").withColumn("rest", rest)
    each = each.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.when(F.col("rest") > 0, F.col("epochs")).otherwise(F.col("epochs") - 1)))).filter("epoch >= 0 and (epoch < epochs or rest > 0)")
    key = F.conv(F.substring(F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("epoch").cast("string"), F.lit(str(seed)))), 1, 12), 16, 10).cast("bigint")
    each = each.withColumn("order_key", key).withColumn("range", F.floor(F.col("order_key") / F.lit(float(1 << 48)) * F.col("ranges")).cast("bigint"))
    per_range = each.groupBy("source", "epoch", "range").agg(F.sum("n_tokens").alias("in_range"))
    before = Window.partitionBy("source", "epoch").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = per_range.withColumn("base", F.coalesce(F.sum("in_range").over(before), F.lit(0))).drop("in_range")
    inside = Window.partitionBy("source", "epoch", "range").orderBy("order_key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    placed = each.join(per_range, ["source", "epoch", "range"]).withColumn("start", F.col("base") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    placed = placed.filter("epoch < epochs or start + n_tokens <= rest")
    done = (F.col("epoch") * F.col("tokens") + F.col("start")) / F.col("quota").cast("double")
    return placed.select(
        F.col("doc_id").alias(id_col), "source", "n_tokens", "epoch", F.least(F.floor(done * F.lit(float(blocks))), F.lit(blocks - 1)).cast("bigint").alias("block"), "order_key"
    )


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def op3_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
