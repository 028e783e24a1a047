"""Mixing sources to target weights: temperature mixing realised as budgeted block permutations.

A source's share p of all tokens becomes the weight p**a / sum(p**a). The exponent a is
bisected: it is the greatest in [0, 1] at which the weights' entropy reaches its target,
raised as far as needed so that no source is repeated more often than the limit. Weights
times the token budget are the sources' token budgets.

Each source is cut into blocks of documents by a hash of their ids. An epoch is a permutation
of a source's blocks, and documents keep a hashed order inside a block. A source is taken
epoch by epoch until its budget is met: whole epochs repeat, the last one is cut. A
document's place in its source's budget, as a fraction, is its place in the mix, so that
every stretch of the mix holds the sources in their target proportions.

Scale: token counts are summed for each source and block first; places come from those sums
(one row a source, block and epoch) and from sums inside a block. No task holds a source.

Cases: a null source is a source of its own; a null text has no words and counts one token,
its end; rows that share a ``doc_id`` are told apart by their text, and identical ones take
neighbouring places; one source alone keeps its weight of 1; an empty table gives an empty
result; a budget of so many tokens that no weights keep to the repetition limit is refused; other
columns are ignored by ``mix`` and kept by ``mixed_documents``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import SPACES, saved, set_aside, table

#: Entropy to reach, as a share of the way from the natural mix's to that of equal weights.
ENTROPY_SHARE = 0.5
#: No source may be read more often than this.
MOST_EPOCHS = 4.0
#: Documents of a block, at which the number of blocks of the largest source is aimed.
BLOCK_DOCS = 2_000
#: Documents of a stretch of the mix, within which the order is hashed.
STRETCH_DOCS = 2_000
#: Exponents tried in one pass over the sources, and passes: the exponent is known to 65**-5.
TRIED, PASSES = 64, 5
SEED = 17


def tokens(text: Column) -> Column:
    """Words of a text and its end."""
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")).cast("long") + 1


def exponent(sources: DataFrame, budget: int, entropy_share: float = ENTROPY_SHARE, most_epochs: float = MOST_EPOCHS) -> float:
    """The exponent for ``sources(source, tokens)``, by a many-way bisection.

    Each pass tries ``TRIED`` exponents at once, as aggregates; sources never leave the cluster.
    """
    first = sources.agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t")).first()
    n, total = first["n"], first["t"]
    if n < 2:
        return 1.0
    share = F.col("tokens") / F.lit(float(total))
    natural = sources.agg(F.sum(-share * F.log(share)).alias("h")).first()["h"]
    target = natural + entropy_share * (math.log(n) - natural)

    def tried(exponents: list[float]) -> tuple[list[bool], list[bool]]:
        """Whether each exponent reaches the entropy, and whether it keeps to the repetition limit."""
        power = [F.pow(share, F.lit(a)) for a in exponents]
        sums = sources.agg(*[x for i, (a, p) in enumerate(zip(exponents, power, strict=True)) for x in (F.sum(p).alias(f"z{i}"), F.sum(p * F.lit(a) * F.log(share)).alias(f"g{i}"), F.max(p / F.col("tokens")).alias(f"r{i}"))]).first()
        flat = [math.log(sums[f"z{i}"]) - sums[f"g{i}"] / sums[f"z{i}"] >= target - 1e-12 for i in range(len(exponents))]
        within = [sums[f"r{i}"] / sums[f"z{i}"] * budget <= most_epochs + 1e-12 for i in range(len(exponents))]
        return flat, within

    # Entropy falls with the exponent, repetition too: find where each turns, take the greater exponent.
    def turn(which: int, default: float) -> float:
        lo, hi = 0.0, 1.0
        for _ in range(PASSES):
            grid = [lo + (hi - lo) * i / (TRIED + 1) for i in range(TRIED + 2)]
            good = tried(grid)[which]
            if which == 0:  # greatest exponent that is flat enough
                flat = [i for i in range(len(grid)) if good[i]]
                if not flat:
                    return default
                k = flat[-1]
            else:  # least exponent within the limit is in the cell before the first good one
                ok = [i for i in range(len(grid)) if good[i]]
                if not ok:
                    return default
                k = max(ok[0] - 1, 0)
                if ok[0] == 0:
                    return grid[0]
            lo, hi = grid[k], grid[min(k + 1, len(grid) - 1)]
            if lo == hi:
                break
        return lo if which == 0 else hi

    least = turn(1, 1.0)
    best = turn(0, least)
    return round(max(best, least), 9)


def mix(docs: DataFrame, budget: int | None = None, entropy_share: float = ENTROPY_SHARE, most_epochs: float = MOST_EPOCHS, seed: int = SEED, row: str | None = None) -> DataFrame:
    """A row for each time a document is taken.

    ``row, doc_id, source, tokens, epoch, weight, source_budget, place`` (fraction of the mix)
    and ``stretch``, with ``slot`` the order inside a stretch. ``row`` is the column of that name, if one is named.
    """
    given = F.col(row) if row else F.lit(None).cast("long")
    slim = docs.select(given.alias("row"), "doc_id", F.coalesce("source", F.lit("")).alias("_s"), F.col("source").isNull().alias("_n"), tokens(F.col("text")).alias("tokens"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("_h"))
    slim = saved(slim, "mix-tokens")
    sources = saved(slim.groupBy("_s", "_n").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), "mix-sources")
    whole = sources.agg(F.sum("tokens").alias("t"), F.sum("docs").alias("d"), F.max("docs").alias("m")).first()
    total, n_docs = whole["t"] or 0, whole["d"] or 0
    budget = total if budget is None else budget
    if budget > most_epochs * total:
        raise ValueError(f"a budget of {budget} tokens reads {total} tokens more than {most_epochs} times")
    a = exponent(sources.withColumnRenamed("_s", "source"), budget, entropy_share, most_epochs) if total else 1.0
    power = F.pow(F.col("tokens") / F.lit(float(max(total, 1))), F.lit(a))
    norm = sources.agg(F.sum(power)).first()[0] or 1.0
    # Rounded, so that the order in which sums were taken can't move a cut.
    plan = sources.select("_s", "_n", F.col("tokens").alias("_total"), F.round(power / F.lit(norm), 9).alias("weight"))
    plan = plan.withColumn("source_budget", F.round(F.col("weight") * F.lit(float(budget))).cast("long"))
    plan = plan.withColumn("_whole", F.floor(F.col("source_budget") / F.col("_total")).cast("int")).withColumn("_rest", F.col("source_budget") - F.col("_whole") * F.col("_total"))
    blocks = max(1, -(-(whole["m"] or 0) // BLOCK_DOCS))
    slim = slim.withColumn("_block", F.pmod(F.col("_h"), F.lit(blocks)))
    sums = slim.groupBy("_s", "_n", "_block").agg(F.sum("tokens").alias("_b"))
    epochs = sums.join(plan, ["_s", "_n"]).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("_whole"))))
    order = Window.partitionBy("_s", "_n", "epoch").orderBy(F.xxhash64(F.lit(seed), "_s", "_block", "epoch"), "_block").rowsBetween(Window.unboundedPreceding, -1)
    epochs = epochs.withColumn("_before", F.coalesce(F.sum("_b").over(order), F.lit(0)) + F.col("epoch") * F.col("_total")).filter(F.col("_before") < F.col("source_budget"))
    inside = Window.partitionBy("_s", "_n", "_block").orderBy("_h", "doc_id", "row").rowsBetween(Window.unboundedPreceding, -1)
    placed = slim.withColumn("_within", F.coalesce(F.sum("tokens").over(inside), F.lit(0)))
    taken = placed.join(epochs.drop("_b"), ["_s", "_n", "_block"]).withColumn("_at", F.col("_before") + F.col("_within")).filter(F.col("_at") < F.col("source_budget"))
    # A document that starts inside the budget is taken; places run over the budget.
    place = (F.col("_at") + F.lit(0.5)) / F.col("source_budget")
    stretches = max(1, -(-n_docs // STRETCH_DOCS))
    taken = taken.withColumn("place", place).withColumn("stretch", F.least(F.floor(F.col("place") * stretches).cast("long"), F.lit(stretches - 1).cast("long")))
    slot = F.row_number().over(Window.partitionBy("stretch").orderBy(F.xxhash64("_h", "epoch"), "doc_id", "epoch", "row")) - 1
    return taken.select("row", "doc_id", F.when(~F.col("_n"), F.col("_s")).alias("source"), "tokens", "epoch", "weight", "source_budget", "place", "stretch", slot.cast("long").alias("slot"))


def mixed_documents(docs: DataFrame, **settings: object) -> DataFrame:
    """The documents of the mix with all their columns, a row for each time one is taken."""
    # Row numbers hold only once they are written.
    docs, back = set_aside(docs, ("_row",))
    numbered = saved(docs.withColumn("_row", F.monotonically_increasing_id()), "mix-documents")
    taken = mix(numbered, row="_row", **settings).select(F.col("row").alias("_row"))
    return back(numbered.join(taken, "_row").drop("_row"))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc_id", "source", "tokens", "epoch", "weight", "source_budget", "place", "stretch", "slot")
