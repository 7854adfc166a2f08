"""Mixing sources to target weights by temperature.

A source's weight is its share of the corpus' tokens to the power of an exponent, made to
sum to one. The exponent is bisected until the weights have a wanted entropy, or until no
source is repeated more often than a limit. A source's part of the token budget is realised
as whole epochs and one part of an epoch. Documents belong to blocks by a hash of their id;
each epoch is a permutation of the blocks, and its part is the blocks that come first, the
last of them cut between documents so that the budget isn't exceeded.
"""

from __future__ import annotations

from collections.abc import Callable
from math import log

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanery.llm import common

#: Blocks of each source. The part of a source that is looked at document by document is one.
BLOCKS = 65_536
SEED = 20_011
STEPS = 60


def word_tokens(text: str = "text") -> Column:
    """Tokens of a text: its runs of other than white space. A null text has none."""
    return F.regexp_count(common.whole(text), F.lit(r"\S+")).cast("long")


def weights(tokens: np.ndarray, exponent: float, times: np.ndarray | int = 1) -> np.ndarray:
    """Weights of sources with these totals, each of ``times`` sources; one without tokens has none."""
    logs = np.where(tokens > 0, np.log(np.maximum(tokens, 1)), -np.inf) * max(exponent, 1e-12)
    raised = np.exp(logs - logs.max())
    raised[tokens <= 0] = 0.0
    return raised / (raised * times).sum()


def entropy(shares: np.ndarray, times: np.ndarray | int = 1) -> float:
    times = np.broadcast_to(times, shares.shape)[shares > 0]
    shares = shares[shares > 0]
    return float(-(times * shares * np.log(shares)).sum())


def bisect(enough: Callable[[float], bool], low: float, high: float) -> float:
    """The least exponent from ``low`` to ``high`` that is enough; ``high`` must be."""
    if enough(low):
        return low
    for _ in range(STEPS):
        middle = (low + high) / 2
        low, high = (low, middle) if enough(middle) else (middle, high)
    return high


def solve(
    tokens: np.ndarray,
    *,
    budget: int | None,
    entropy_target: float | None = None,
    repeat_limit: float | None = None,
    times: np.ndarray | None = None,
) -> tuple[float, np.ndarray, np.ndarray]:
    """``(exponent, weights, tokens to draw)`` of sources with these totals.

    ``times`` tells how many sources have each total, 1 by default.
    ``entropy_target`` is a share of the highest entropy, that of equal weights; the exponent
    lies from 0 (equal weights) up to where entropy has fallen to the target. A
    ``repeat_limit`` raises it, up to 1, until no source is drawn more often than that.
    ``budget`` None is the least that draws every source in full once.
    """
    times = np.ones(len(tokens), np.int64) if times is None else times
    sources = int(times[tokens > 0].sum())
    if not sources:
        return 1.0, np.zeros(len(tokens)), np.zeros(len(tokens), np.int64)

    def drawn(exponent):
        shares = weights(tokens, exponent, times)
        whole = (tokens[tokens > 0] / shares[tokens > 0]).max() if budget is None else budget
        return shares, shares * whole

    exponent = 0.0
    if entropy_target is not None:
        wanted = entropy_target * log(sources) if sources > 1 else 0.0
        exponent = bisect(lambda a: a >= 64 or entropy(weights(tokens, a, times), times) <= wanted, 0.0, 64.0)
    if repeat_limit is not None:
        def within(a):
            return bool((drawn(a)[1] <= repeat_limit * tokens * (1 + 1e-9))[tokens > 0].all())

        if not within(1.0):
            raise ValueError("the budget exceeds what the sources give within the repeat limit")
        if not within(exponent):
            exponent = bisect(within, exponent, max(1.0, exponent))
    shares, parts = drawn(exponent)
    return exponent, shares, np.floor(parts + 1e-6).astype(np.int64)


def mix(
    df: DataFrame,
    *,
    source: str = "source",
    id: str = "doc_id",
    tokens: Column | None = None,
    budget: int | None = None,
    budget_share: float | None = None,
    entropy_target: float | None = None,
    repeat_limit: float | None = None,
    seed: int = SEED,
    placed: bool = True,
) -> DataFrame:
    """The rows of ``df`` as often as the mixture draws them.

    ``budget`` counts tokens; ``budget_share`` is one as a share of the corpus' tokens; with
    neither, the least budget that draws every document at least once. With ``placed``, the
    columns ``mix_epoch``, ``mix_block``, ``mix_key`` and ``mix_tokens`` are added (replacing
    such columns): within a source, the order of drawing is epoch, key, block. A null source
    is a source like any other; one without a token is drawn once, or not if there is a budget. Rows without tokens go
    with their block. Rows with one id share a block; repeated rows are drawn each. Empty
    tables give no rows.
    """
    tokens = word_tokens() if tokens is None else tokens
    added = ("mix_epoch", "mix_block", "mix_key", "mix_tokens") if placed else ()
    block = F.pmod(F.xxhash64(F.col(f"`{id}`").cast("string"), F.lit(seed)), F.lit(BLOCKS)).cast("int")
    # the caller's columns travel in one, so that no name of theirs meets one of these
    rows = df.select(
        F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"),
        F.col(f"`{source}`").cast("string").alias("source"),
        F.col(f"`{id}`").alias("id"),
        block.alias("block"),
        tokens.alias("tokens"),
    )
    blocks = common.stage(rows.groupBy("source", "block").agg(F.sum("tokens").alias("n")), "blocks")
    totals = common.stage(blocks.groupBy("source").agg(F.sum("n").alias("n")), "totals")
    # weights depend on totals alone. There are at most sqrt(2 * tokens) different ones, whatever the sources
    alike = sorted((r.n, r["count"]) for r in totals.where("n is not null").groupBy("n").count().collect())
    counts, times = (np.array(c, np.int64) for c in (zip(*alike) if alike else ((), ())))
    if budget is None and budget_share is not None:
        budget = int(budget_share * (counts * times).sum())
    _, _, parts = solve(
        counts, budget=budget, entropy_target=entropy_target, repeat_limit=repeat_limit, times=times
    )
    by_total = df.sparkSession.createDataFrame(
        [(n, int(part // n), int(part % n)) for n, part in zip(counts.tolist(), parts.tolist()) if n and part],
        "n long, epochs long, rest long",
    )
    # one row a source; Spark broadcasts it while its files are within the limit for that
    plan = common.stage(totals.join(by_total, "n").select(F.col("source").alias("of"), "epochs", "rest"), "plan")
    in_plan = F.col("source").eqNullSafe(F.col("of"))

    def key(epoch):
        return F.xxhash64(F.lit(seed), F.col("source"), epoch, F.col("block"))

    # the part of an epoch: where in the permutation of its blocks the rest is used up
    before = Window.partitionBy("source").orderBy("key", "block")
    cuts = (
        blocks.join(plan, in_plan)
        .withColumn("key", key(F.col("epochs")))
        .withColumn("upto", F.sum("n").over(before.rowsBetween(Window.unboundedPreceding, 0)))
        .where("upto > rest")
        .groupBy("of", "epochs")
        .agg(F.min(F.struct("key", "block", (F.col("rest") - F.col("upto") + F.col("n")).alias("left"))).alias("cut"))
        .select("of", "epochs", F.col("cut.key").alias("cut_key"), F.col("cut.block").alias("cut_block"), F.col("cut.left").alias("room"))
    )
    if budget is None:
        # sources without tokens are one epoch: a cut that lies behind no block
        never = (F.lit(1).cast("long"), F.lit(-(2**63)).cast("long"), F.lit(-1), F.lit(0).cast("long"))
        cuts = cuts.union(totals.where("coalesce(n, 0) = 0").select("source", *never))
    cuts = common.stage(cuts, "cuts")
    there = rows.join(cuts, in_plan)
    at = key(F.col("epochs"))
    ahead = (at < F.col("cut_key")) | ((at == F.col("cut_key")) & (F.col("block") < F.col("cut_block")))
    drawn = F.col("epochs") + ahead.cast("long")
    whole = there.where(drawn > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), drawn - 1)))
    order = Window.partitionBy("source").orderBy(
        F.xxhash64(F.lit(seed), F.col("id").cast("string"), F.lit("row")), "id", "tokens"
    )
    cut = (
        there.where((at == F.col("cut_key")) & (F.col("block") == F.col("cut_block")))
        .withColumn("upto", F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
        .where("upto <= room")
        .drop("upto")
        .withColumn("epoch", F.col("epochs"))
    )
    out = whole.unionByName(cut)
    names = [F.col("row").getField(c).alias(c) for c in df.columns if c.lower() not in added]
    if not placed:
        return out.select(*names)
    places = zip(added, (F.col("epoch"), F.col("block"), key(F.col("epoch")), F.col("tokens")))
    return out.select(*names, *[value.alias(name) for name, value in places])


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many tokens as the corpus has, at 95 % of the highest entropy, four epochs at most."""
    documents = common.table(spark, sf_dir, "documents")
    drawn = mix(
        documents.select("doc_id", "source", word_tokens().alias("tokens")),
        tokens=F.col("tokens"),
        budget_share=1.0,
        entropy_target=0.95,
        repeat_limit=4.0,
    )
    return drawn.select(
        "doc_id",
        "source",
        F.col("mix_epoch").alias("epoch"),
        F.col("mix_block").alias("block"),
        F.col("mix_key").alias("block_key"),
        F.col("mix_tokens").alias("n_tokens"),
    )
