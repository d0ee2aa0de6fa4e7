"""Mixing lanes of shards to target shares: temperature mixing, realised as block permutations.

A lane of token share p gets the weight p to the power alpha. Of a plan, one exponent is bisected first, to
the entropy of the plan's shares (or to an entropy given); from there each lane's own exponent is bisected
until the normalised weight is the lane's target share. The largest total is taken at which no lane has to use
its shards more than ``max_repeats`` times. Within a lane the tokens are spread over its shards in the same way:
a shard of token share p weighs p to the power alpha, alpha being bisected to the least value in [0, 1] (the
flattest mixture) whose most repeated shard stays within the limit. Weights are realised as whole and
fractional uses. Shards of like size form blocks of at most about BLOCK_ROWS shards by hash; the fractional uses of a lane are
laid end to end, block by block, each block in a hash permutation, and a shard is used once more where the
running sum passes a whole number, so every block, and the lane, keeps its budget to about one shard.
Shards are never collected: bisection sums a histogram of shard sizes, running sums go by blocks.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from textloom.storage import materialize

#: Shard sizes are grouped by so many steps a doubling.
STEPS = 16
#: Shards of one lane and size are split by hash into blocks of about so many.
BLOCK_ROWS = 20_000
#: Spare room kept below the repetition limit, for the grouping of sizes.
MARGIN = 1e-9


def lane_name(col):
    """One spelling of a lane: trimmed, lower case, without a ``_lane`` ending; null stays null."""
    return F.regexp_replace(F.lower(F.trim(col)), r"[_\s-]*lane$", "")


def current_shards(registry: DataFrame) -> DataFrame:
    """(shard_id, lane, tokens): the last registration of each shard that has a count and a lane.

    A shard registered twice counts once, with its latest count; where the latest row lacks a count or
    lane, the latest row that has it fills in. Shards without any positive count, and shards without any
    lane, can serve no target and are left out. Ties in time go to the larger count, then the lane's name.
    """
    lane = lane_name("capability_lane")
    return (
        registry.where("shard_id IS NOT NULL")
        .select("shard_id", F.nullif(lane, F.lit("")).alias("lane"), F.when(F.col("token_count") > 0, F.col("token_count")).alias("tokens"), "registered_at")
        .groupBy("shard_id")
        .agg(
            F.max_by("lane", F.when(F.col("lane").isNotNull(), F.struct("registered_at", "lane"))).alias("lane"),
            F.max_by("tokens", F.when(F.col("tokens").isNotNull(), F.struct("registered_at", "tokens"))).alias("tokens"),
        )
        .where("lane IS NOT NULL AND tokens IS NOT NULL")
    )


def bisect_alpha(sizes: list[tuple[float, int]], budget: float, limit: float) -> float:
    """The least alpha in [0, 1] at which budget * w / tokens <= limit for every shard.

    ``sizes`` holds (tokens, number of shards). The most repeated shard is the smallest for alpha < 1.
    At alpha = 1 all shards repeat alike, budget / total times, which the budget's choice keeps within limit.
    """
    total = sum(t * n for t, n in sizes)
    small = min(t for t, _ in sizes)

    def most(alpha: float) -> float:
        norm = sum(n * (t / total) ** alpha for t, n in sizes)
        return budget * (small / total) ** alpha / norm / small

    if most(0.0) <= limit:
        return 0.0
    lo, hi = 0.0, 1.0
    for _ in range(60):
        mid = (lo + hi) / 2
        lo, hi = (lo, mid) if most(mid) <= limit * (1 - MARGIN) else (mid, hi)
    return hi


def entropy(shares: list[float]) -> float:
    """Shannon entropy of a mixture, in bits."""
    return -sum(p * math.log2(p) for p in shares if p > 0)


def tempered(shares: list[float], alpha: float) -> list[float]:
    """Shares to the power alpha, scaled to one; what has no share gets none."""
    top = max(shares)
    w = [(p / top) ** alpha if p > 0 else 0.0 for p in shares]
    return [x / sum(w) for x in w]


def _bisect(f, lo: float, hi: float) -> float:
    """The point where the falling function f passes zero; an end where it does not."""
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) > 0 else (lo, mid)
    return (lo + hi) / 2


def entropy_alpha(shares: list[float], bits: float, most: float = 64.0) -> float:
    """The exponent in [0, most] at which the tempered shares have ``bits`` of entropy: 0 is the even mixture,
    1 the natural one; entropies out of reach give an end."""
    return _bisect(lambda a: entropy(tempered(shares, a)) - bits, 0.0, most)


def lane_exponents(shares: list[float], targets: list[float]) -> tuple[float, list[float]]:
    """(alpha of the plan, alpha of each lane): the plan's meets the entropy of the targets; a lane's is
    bisected until its weight, over the sum of the plan's weights, is its target share. A lane that holds all tokens
    weighs one at any exponent and keeps the plan's; so does a lane without tokens."""
    plan = entropy_alpha(shares, entropy(targets))
    whole = sum(p**plan for p in shares if p > 0)
    out = []
    for p, t in zip(shares, targets, strict=True):
        if not 0 < p < 1 or t <= 0:
            out.append(plan)
            continue
        reach = 1.0
        while p**-reach < t * whole or p**reach > t * whole:
            reach *= 2
        out.append(_bisect(lambda a, p=p, t=t: p**a - t * whole, -reach, reach))
    return plan, out


def _plans(shards: DataFrame, targets: DataFrame, bits: float | None) -> tuple[list[tuple], list[tuple]]:
    """(plan_id, lane, target, limit, lane_tokens, natural, plan_alpha, lane_alpha, budget, alpha, norm) of every plan and
    lane, and (lane, step, n_blocks) of the histogram of shard sizes."""
    step = F.floor(F.log2("tokens") * STEPS).cast("int")
    # the histogram has at most 64 x STEPS rows a lane, whatever the number of shards
    hist = shards.groupBy("lane", step.alias("step")).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n"), F.min("tokens").alias("least")).collect()
    by: dict[str, list] = {}
    for r in hist:
        by.setdefault(r.lane, []).append((r.tokens / r.n, r.n, r.least))
    plans: dict[int, list] = {}
    for r in spelled_targets(targets).orderBy("plan_id", "lane").collect():
        plans.setdefault(r.plan_id, []).append((r.lane, r.target_share, r.max_repeats))
    out = []
    for plan, lanes in plans.items():
        tokens = {lane: sum(t * n for t, n, _ in by.get(lane, [])) for lane, _, _ in lanes}
        whole = sum(tokens.values())
        natural = [tokens[lane] / whole if whole else 0.0 for lane, _, _ in lanes]
        if not whole:
            plan_alpha, exponents, weights = 1.0, [1.0] * len(lanes), [0.0] * len(lanes)
        elif bits is None:
            plan_alpha, exponents = lane_exponents(natural, [s for _, s, _ in lanes])
            weights = [p**a if p > 0 else 0.0 for p, a in zip(natural, exponents, strict=True)]
        else:
            plan_alpha = entropy_alpha(natural, bits)
            exponents, weights = [plan_alpha] * len(lanes), tempered(natural, plan_alpha)
        norm = sum(weights)
        if bits is None and not all(p > 0 for p in natural):
            norm = 0.0  # a lane without tokens: no total reaches the plan
        total = min((m * tokens[lane] / (w / norm) for (lane, _, m), w in zip(lanes, weights, strict=True) if w > 0), default=0) if norm else 0
        for (lane, s, m), p, a, w in zip(lanes, natural, exponents, weights, strict=True):
            sizes = [(t, n) for t, n, _ in by.get(lane, [])]
            budget = total * w / norm if norm else 0.0
            row = (plan, lane, s, m, float(tokens[lane]), p, plan_alpha, a)
            if not sizes or budget <= 0:
                out.append((*row, 0.0, 1.0, 1.0))
                continue
            least = min(x for _, _, x in by[lane])
            alpha = bisect_alpha([*sizes, (least, 0)], budget, m)
            out.append((*row, float(budget), alpha, sum(n * (t / tokens[lane]) ** alpha for t, n in sizes)))
    return out, [(r.lane, r.step, -(-r.n // BLOCK_ROWS)) for r in hist]


def spelled_targets(targets: DataFrame) -> DataFrame:
    """(plan_id, lane, target_share, max_repeats): one row of each plan and lane, spellings summed, a plan's shares
    scaled to one; of differing limits the largest, at least one. Null plans, lanes and shares, and shares not above zero, are left out."""
    lane = lane_name("lane")
    rows = targets.where("plan_id IS NOT NULL AND lane IS NOT NULL AND target_share > 0").select("plan_id", lane.alias("lane"), "target_share", F.greatest(F.lit(1), F.coalesce("max_repeats", F.lit(1))).alias("m"))
    sums = rows.groupBy("plan_id", "lane").agg(F.sum("target_share").alias("share"), F.max("m").alias("max_repeats"))
    return sums.select("plan_id", "lane", (F.col("share") / F.sum("share").over(W.partitionBy("plan_id"))).alias("target_share"), "max_repeats")


PLAN = "plan_id int, lane string, target double, max_repeats int, lane_tokens double, natural double, plan_alpha double, lane_alpha double, budget double, alpha double, norm double"


def _realised(registry: DataFrame, targets: DataFrame, bits: float | None) -> tuple[DataFrame, DataFrame]:
    """The plans, a row of each plan and lane, and the uses of every shard under every plan."""
    spark = registry.sparkSession
    shards = materialize(current_shards(registry), "p1-shards")
    rows, blocks_of = _plans(shards, targets, bits)
    plans = spark.createDataFrame(rows, PLAN)
    share = F.col("tokens") / F.col("lane_tokens")
    want = F.when(F.col("budget") > 0, F.least(F.col("max_repeats").cast("double"), F.col("budget") * F.pow(share, F.col("alpha")) / F.col("norm") / F.col("tokens"))).otherwise(0.0)
    rows = shards.join(plans, "lane").withColumn("exact", want).withColumn("step", F.floor(F.log2("tokens") * STEPS).cast("int"))
    rows = rows.withColumn("sure", F.floor(F.col("exact") + 1e-9).cast("long")).withColumn("rest", F.greatest(F.lit(0.0), F.col("exact") - F.col("sure")))
    counts = spark.createDataFrame(blocks_of, "lane string, step int, n_blocks long")
    place = F.xxhash64("plan_id", "shard_id")
    rows = rows.join(counts, ["lane", "step"]).withColumn("place", place).withColumn("block", F.pmod(place, "n_blocks"))
    rows = materialize(rows, "p1-rows")
    # running sums: over blocks first (a row for BLOCK_ROWS shards, or for each step), then within each block's permutation
    before = W.partitionBy("plan_id", "lane").orderBy("step", "block").rowsBetween(W.unboundedPreceding, -1)
    blocks = rows.groupBy("plan_id", "lane", "step", "block").agg(F.sum("rest").alias("r"))
    blocks = blocks.select("plan_id", "lane", "step", "block", F.coalesce(F.sum("r").over(before), F.lit(0.0)).alias("base"))
    inside = W.partitionBy("plan_id", "lane", "step", "block").orderBy("place", "shard_id").rowsBetween(W.unboundedPreceding, 0)
    run = rows.join(blocks, ["plan_id", "lane", "step", "block"]).withColumn("upto", F.col("base") + F.sum("rest").over(inside))
    # systematic rounding: a shard gets one more use where the running sum of fractional uses passes a whole number
    extra = (F.floor(F.col("upto") + 1e-6) > F.floor(F.col("upto") - F.col("rest") + 1e-6)) & (F.col("sure") < F.col("max_repeats"))
    return plans, run.select("plan_id", "lane", "shard_id", F.col("tokens").alias("token_count"), F.col("exact").alias("weight"), (F.col("sure") + extra.cast("long")).alias("uses"))


def mixture_uses(registry: DataFrame, targets: DataFrame, bits: float | None = None) -> DataFrame:
    """(plan_id, lane, shard_id, token_count, weight, uses): uses of every shard under every plan.

    Unused shards have 0 uses. Targets of a plan are scaled to one; a lane without shards makes a
    plan impossible and all its uses 0. Empty tables give an empty result. With ``bits`` the lanes of a plan are
    mixed at one temperature, that of so many bits of entropy, and their target shares only name them.
    """
    return _realised(registry, targets, bits)[1]


def mixture_report(registry: DataFrame, targets: DataFrame, checkpoints: DataFrame, bits: float | None = None) -> DataFrame:
    """(plan_id, lane, target_share, natural_share, plan_alpha, lane_alpha, reached_share, seen_share, tokens, most_uses,
    max_repeats, n_shards, target_bits, reached_bits): one row of each plan and lane, however it is spelled.

    ``seen_share`` is the lane's share of the distinct microbatches of the checkpoints whose lane is known; the
    bits are the entropies of a plan's target and reached shares.
    """
    plans, uses = _realised(registry, targets, bits)
    lanes = uses.groupBy("plan_id", "lane").agg(F.sum(F.col("uses") * F.col("token_count")).alias("tokens"), F.max("uses").alias("most_uses"), F.count("*").alias("n_shards"))
    whole = W.partitionBy("plan_id")
    lanes = lanes.withColumn("reached", F.try_divide(F.col("tokens"), F.sum("tokens").over(whole)))
    seen = checkpoints.dropDuplicates(["run_id", "branch_id", "global_step", "checkpoint_id", "worker_rank", "microbatch_id"]).select(F.nullif(lane_name("mixture_lane"), F.lit("")).alias("lane"))
    seen = seen.where("lane IS NOT NULL").groupBy("lane").agg(F.count("*").alias("n"))
    seen = seen.select("lane", F.round(F.col("n") / F.sum("n").over(W.partitionBy(F.lit(1))), 6).alias("seen_share"))  # a row of each lane
    told = plans.select("plan_id", "lane", "target", "natural", "plan_alpha", "lane_alpha", "max_repeats").join(lanes, ["plan_id", "lane"], "left").join(seen, "lane", "left")
    bits_of = lambda c: F.round(-F.sum(F.when(c > 0, c * F.log2(c)).otherwise(0.0)).over(whole), 6)
    return told.select(
        "plan_id", "lane", F.round("target", 6).alias("target_share"), F.round("natural", 6).alias("natural_share"), F.round("plan_alpha", 6).alias("plan_alpha"), F.round("lane_alpha", 6).alias("lane_alpha"),
        F.round("reached", 6).alias("reached_share"), "seen_share", F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("most_uses", F.lit(0)).alias("most_uses"), "max_repeats",
        F.coalesce("n_shards", F.lit(0)).alias("n_shards"), bits_of(F.col("target")).alias("target_bits"), bits_of(F.col("reached")).alias("reached_bits"),
    )
