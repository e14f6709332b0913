"""Groups of linked records by random-mate contraction, and splits that keep groups together."""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..operators.ranges import range_blocks, running_total
from ..operators.skew import Skew
from ..session import cut, forget


def _coins(live: DataFrame, turn: int) -> DataFrame:
    """(v, head) for each vertex of the edges: a coin, biased 15 to 1.

    A vertex whose rank (degree, then a random number) is above all its neighbours' mostly shows heads, any
    other mostly tails: so the leaves of a star go in one or two rounds, not a quarter of them in each.
    """
    bits = F.xxhash64("a", F.lit(turn))
    rank = F.least(F.count("*"), F.lit(1 << 20)) * F.lit(1 << 40) + F.shiftrightunsigned(F.first(bits), 24)
    own = live.groupBy("a").agg(rank.alias("rank"))
    best = live.join(own.select(F.col("a").alias("b"), F.col("rank").alias("other")), "b").groupBy("a").agg(F.max("other").alias("other"))
    top, rare = F.col("rank") > F.col("other"), F.pmod(bits, F.lit(16)) == 0
    return own.join(best, "a").select(F.col("a").alias("v"), (top != rare).alias("head"))


def contract(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """(v, root) for every v of vertices: v's of one root are those that edges (a, b) join. Roots are vertices.

    Random-mate contraction: each round every vertex tosses a coin, a vertex with tails collapses into its
    smallest neighbour with heads (a join and a min), and edges are rewritten to the survivors, without loops
    and repeats. Coins are independent of the past, so edges vanish after a logarithmic number of rounds;
    there are no chains to follow within a round. The collapses are then unwound from the last round to the
    first. Null vertices and edges with a null are left out; repeated
    edges, loops and edges to unknown vertices are harmless.
    """
    both = edges.where("a <> b").select("a", "b")
    live = cut(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    hooks: list[DataFrame] = []
    turn = 0
    while not live.isEmpty():
        turn += 1
        coins = cut(_coins(live, turn))
        tails, heads = coins.where("NOT head").select(F.col("v").alias("a")), coins.where("head").select(F.col("v").alias("b"))
        hook = cut(live.join(tails, "a").join(heads, "b").groupBy("a").agg(F.min("b").alias("p")))
        hooks.append(hook)
        to_a, to_b = hook.select("a", F.col("p").alias("pa")), hook.select(F.col("a").alias("b"), F.col("p").alias("pb"))
        moved = live.join(to_a, "a", "left").join(to_b, "b", "left")
        moved = moved.select(F.coalesce("pa", "a").alias("a"), F.coalesce("pb", "b").alias("b"))
        past, live = live, cut(moved.where("a <> b").distinct())
        forget(past, coins)
    labels = None
    for hook in reversed(hooks):
        step = hook.select(F.col("a").alias("v"), F.col("p").alias("root"))
        if labels is not None:
            known = labels.select(F.col("v").alias("root"), F.col("root").alias("_top"))
            step = step.join(known, "root", "left").select("v", F.coalesce("_top", "root").alias("root"))
            past, step = labels, cut(step.unionByName(labels))
            forget(past, hook)
        labels = step
    vertices = vertices.where("v IS NOT NULL").distinct()
    if labels is None:
        return vertices.select("v", F.col("v").alias("root"))
    return vertices.join(labels, "v", "left").select("v", F.coalesce("root", "v").alias("root"))


def linked_groups(df: DataFrame, record: str, entity: Column) -> DataFrame:
    """(record, group): records that share an entity, also through others, have one group, its smallest record.

    Rows with a null record are left out; a null entity links nothing; repeated rows and ties change
    nothing; other columns aren't read; an empty input has an empty result. Each entity's records are joined
    to the smallest of them, which replaces the entity by a star of at most as many edges as it has records.
    """
    pairs = cut(df.select(F.col(record).alias("v"), entity.alias("_e")).where("v IS NOT NULL").distinct())
    first = cut(pairs.where("_e IS NOT NULL").groupBy("_e").agg(F.min("v").alias("b"), F.count("*").alias("_n")))
    edges = Skew(first, ["_e"], "_n").join(pairs, first.select("_e", "b")).select(F.col("v").alias("a"), "b")
    found = cut(contract(edges, pairs.select("v")))
    name = found.groupBy("root").agg(F.min("v").alias("_name"))
    return found.join(name, "root").select(F.col("v").alias(record), F.col("_name").alias("group_id"))


#: Groups that weigh more than one in so many of all are dealt one by one; there are fewer than twice as many.
LARGE = 10_000


def dealt(groups: list[tuple], shares: dict[str, Fraction], total: float, rest: float) -> dict:
    """Splits of large groups (name, weight), heaviest first: each goes to the split that lacks most of its share.

    Where the small groups weigh less (rest) than the splits after the first should, those splits have one of the large
    groups each beforehand, from the lightest up, as long as one is left for the first.
    """
    names, out = [k for k, v in shares.items() if v > 0], {}
    lack = {k: float(shares[k]) * total for k in names}
    groups = sorted(groups, key=lambda g: (-g[1], str(g[0])))
    if rest < sum(lack[k] for k in names[1:]):
        for name in names[1:]:
            if len(groups) > 1:
                g, w = groups.pop()
                out[g], lack[name] = name, lack[name] - w
    for g, w in groups:
        best = max(names, key=lambda k: lack[k])
        out[g], lack[best] = best, lack[best] - w
    return out


def assign_splits(groups: DataFrame, group: str, weight: str, ratios: dict[str, str], seed: int = 42) -> DataFrame:
    """(group, weight, split): whole groups dealt to splits so that the weights come near the ratios.

    Groups heavier than half of the smallest share (fewer than 2 / that share, and than 2 x LARGE) are dealt one by one to the
    split that lacks most; each split has a group if there are as many. All others are put into the order of a seeded
    hash and cut where their cumulative weight passes what each split still lacks, summed block by block. groups
    has one row per group with its weight; null groups are left out, null weights count 0. A split with ratio 0
    has no group, and an empty input no row.
    """
    shares = {k: Fraction(v) for k, v in ratios.items()}
    rows = groups.where(F.col(group).isNotNull()).select(F.col(group).alias("_g"), F.coalesce(F.col(weight).cast("double"), F.lit(0.0)).alias("_w"))
    total = float(rows.agg(F.coalesce(F.sum("_w"), F.lit(0.0))).first()[0])
    large = max(float(min(v for v in shares.values() if v > 0)) / 2, 1 / (2 * LARGE)) * total
    heavy = [(r["_g"], r["_w"]) for r in rows.where(F.col("_w") > large).collect()]
    rest = total - sum(w for _, w in heavy)
    of = dealt(heavy, shares, total, rest)
    have = {k: sum(w for g, w in heavy if of[g] == k) for k in shares}
    lack = {k: max(0.0, float(v) * total - have[k]) for k, v in shares.items()}
    scale = rest / sum(lack.values()) if sum(lack.values()) else 0.0
    order = [F.xxhash64("_g", F.lit(seed)), F.col("_g")]
    run = running_total(range_blocks(rows.where(F.col("_w") <= large), order), order, "_w", "_run")
    middle, split, upto = F.col("_run") - F.col("_w") / 2, F.lit(None).cast("string"), 0.0
    names = [k for k, v in shares.items() if v > 0]
    for name in names[:-1]:
        upto += lack[name] * scale
        split = F.coalesce(split, F.when(middle <= upto, F.lit(name)))
    run = run.select("_g", "_w", F.coalesce(split, F.lit(names[-1])).alias("split"))
    if heavy:
        spark = groups.sparkSession
        named = spark.createDataFrame([(g, w, of[g]) for g, w in heavy], StructType([StructField("_g", rows.schema["_g"].dataType), StructField("_w", DoubleType()), StructField("split", StringType())]))
        run = run.unionByName(named)
    return run.select(F.col("_g").alias(group), F.col("_w").alias(weight), "split")
