"""Mixing sources to target weights by subset-sum budget fitting.

A source's target is split into whole passes over its documents and a rest below one pass. For the rest, documents are counted by exact length; every
length first gives its proportional share, and a bounded-knapsack dynamic programme over the lengths left closes the remaining budget, exactly where a
subset sum exists. Which documents of a length are taken is decided by a seeded hash.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brickyard.llm.common import SPACES, bits_for, bucket_of, ranked
from brickyard.session import written

#: Weights of the sources in their order, repeating.
WEIGHTS = (3, 1, 2)
#: The dynamic programme closes this many words exactly; what lies above goes to one more document of each length first.
REACH = 1 << 16
#: Rows of the table of last hashes, one for each source and length, that `take` sends to all tasks; a larger one is joined as Spark sees fit.
SENT = 1 << 16


def targets(sizes: DataFrame, share: float, cap: float, weights: tuple[int, ...]) -> DataFrame:
    """stratum, source_size, target from (stratum, source_size), one row per source.

    Handing the excess of capped sources to the others by weight until none is above its cap ends at target = min(cap * size, level * weight)
    with one level for all. In the order of cap * size / weight, the level is found from running sums: one short row per source.
    """
    order = Window.partitionBy(F.lit(0)).orderBy("stratum")
    place = (F.row_number().over(order) - 1) % len(weights)
    table = sizes.withColumn("w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place + 1).cast("int")))
    table = table.withColumn("most", F.col("source_size") * F.lit(float(cap))).withColumn("all", F.sum("source_size").over(Window.partitionBy(F.lit(0))) * F.lit(float(share)))
    rising = Window.partitionBy(F.lit(0)).orderBy(F.col("most") / F.col("w"), "stratum")
    table = table.withColumn("full", F.coalesce(F.sum("most").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    table = table.withColumn("rest", F.sum("w").over(rising.rowsBetween(0, Window.unboundedFollowing)))
    table = table.withColumn("level", (F.col("all") - F.col("full")) / F.col("rest"))
    level = F.max(F.when(F.col("level") * F.col("w") <= F.col("most"), F.col("level"))).over(Window.partitionBy(F.lit(0)))
    return table.withColumn("level", level).select(
        "stratum", "source_size", F.least("most", F.coalesce(F.col("level") * F.col("w"), F.col("most"))).cast("double").alias("target"))


def close(lengths: list[int], free: list[int], budget: int) -> list[int]:
    """Bounded knapsack: how many of each length come to `budget`, or to the largest sum below it. The set of reachable sums is the bits of one
    integer; copies of a length are added in powers of two."""
    taken = [0] * len(lengths)
    mask, items, sums = (1 << (budget + 1)) - 1, [], [1]
    for i, n in enumerate(lengths):
        left, k = min(free[i], budget // n), 1
        while left > 0 and not sums[-1] >> budget & 1:
            k = min(k, left)
            items.append((i, k))
            sums.append(sums[-1] | sums[-1] << n * k & mask)
            left, k = left - k, 2 * k
    at = sums[-1].bit_length() - 1
    for (i, k), reached in zip(reversed(items), reversed(sums[:-1]), strict=True):
        if not reached >> at & 1:
            taken[i] += k
            at -= k * lengths[i]
    return taken


def fit(lengths: list[int], counts: list[int], budget: int, total: int) -> list[int]:
    """How many documents of each (rising) length to take so that their lengths come to `budget`, or as near below it as can be reached.

    Each length gives its proportional share, then one more document of each length from the longest on, until the dynamic programme reaches. Where its sum falls short and
    the whole budget is within reach, the programme decides on all documents instead.
    """
    taken = [0 if not total else c * budget // total for c in counts]
    left = budget - sum(n * t for n, t in zip(lengths, taken, strict=True))
    longest_first = range(len(lengths) - 1, -1, -1)
    for i, most in [(i, 1) for i in longest_first] + [(i, counts[i]) for i in longest_first]:
        more = min(counts[i] - taken[i], max(0, left - REACH) // lengths[i], most)
        taken[i] += more
        left -= more * lengths[i]
    rest = close(lengths, [c - t for c, t in zip(counts, taken, strict=True)], left)
    out = [t + r for t, r in zip(taken, rest, strict=True)]
    if sum(n * t for n, t in zip(lengths, out, strict=True)) < budget <= REACH:
        out = max(out, close(lengths, counts, budget), key=lambda x: sum(n * t for n, t in zip(lengths, x, strict=True)))
    return out


def plan(histogram: pd.DataFrame) -> pd.DataFrame:
    """For one source: how many documents of each length come once more, beside the whole passes."""
    rows = histogram.sort_values("size")
    budget = int(rows["budget"].iloc[0])
    worded = rows[rows["size"] > 0]
    lengths, counts = [int(x) for x in worded["size"]], [int(x) for x in worded["n"]]
    extra = fit(lengths, counts, budget, sum(a * b for a, b in zip(lengths, counts, strict=True)))
    return pd.DataFrame({"stratum": worded["stratum"], "size": worded["size"], "extra": extra})


def row_hash(seed: int) -> Column:
    """The same for rows equal in id, text and source."""
    text, source = F.col("text"), F.col("source").cast("string")
    return F.xxhash64(F.lit(seed), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)), F.coalesce(text, F.lit("")), text.isNull(), F.coalesce(source, F.lit("")), source.isNull())


def word_count() -> Column:
    return F.regexp_count(F.coalesce("text", F.lit("")), F.lit(f"[^{SPACES}]+")).cast("long")


def stratum() -> Column:
    """The source as a key without nulls, null last."""
    return F.concat(F.when(F.col("source").isNull(), "n").otherwise("a"), F.coalesce(F.col("source").cast("string"), F.lit("")))


def placed(docs: DataFrame, share: float, cap: int, weights: tuple[int, ...], seed: int) -> DataFrame:
    """doc_id, h, stratum, size, source_size, target, passes, extra, place: a row comes `passes` times, and once more if its place among its length is below `extra`."""
    stored = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), word_count().alias("size"), stratum().alias("stratum"), row_hash(seed).alias("h")))
    bits = bits_for(stored.count())
    histogram = written(stored.groupBy("stratum", "size").agg(F.count("*").alias("n")))
    sizes = histogram.groupBy("stratum").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    budget = F.floor(F.col("target") - F.col("passes") * F.col("source_size") + 0.5).cast("long")
    goal = written(targets(sizes, share, cap, weights).withColumn("passes", whole).withColumn("budget", budget))
    fitted = written(histogram.join(goal.select("stratum", "passes", "budget"), "stratum").groupBy("stratum")
                     .applyInPandas(plan, "stratum string, size long, extra long"))
    place = ranked(stored.withColumn("bucket", bucket_of(F.col("h"), bits)), ["stratum", "size"], "bucket", ["h", "doc_id"], "place")
    picked = place.join(fitted, ["stratum", "size"], "left").join(goal.drop("budget"), "stratum")
    return picked.withColumn("extra", F.coalesce("extra", F.lit(0)))


def mix_sources(docs: DataFrame, share: float = 1.5, cap: int = 2, weights: tuple[int, ...] = WEIGHTS, seed: int = 5) -> DataFrame:
    """doc_id, h, size, source_size, target, copies, taken: one row per row of `docs`.

    Size: words `[^\\x20\\x09-\\x0D]+` (null text: 0). Sources are ordered by code point, null last and a source of its own. `copies` is how often the mix
    takes the document (0 to `cap`), `taken` the words. Documents without words are in no budget: they come as often as the source has whole passes.
    Rows equal in id, text and source are interchangeable. An empty table gives an empty result; other columns are ignored. A source's histogram has one row
    per distinct length and is fitted in one task; documents of one length are ranked bucket by bucket, so neither a hot source nor a hot length meets in one task.
    """
    copies = (F.col("passes") + F.when(F.col("place") < F.col("extra"), 1).otherwise(0)).cast("long")
    return placed(docs, share, cap, weights, seed).select(
        "doc_id", "h", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def take(docs: DataFrame, share: float = 1.5, cap: int = 2, weights: tuple[int, ...] = WEIGHTS, seed: int = 5) -> DataFrame:
    """The mix: the rows of `docs`, each as often as the mix takes it (not at all, once or twice).

    Places rise with the hash, so one hash for each source and length tells which rows come once more, and the texts stay where they are unless that table is
    large. Rows equal in id, text and source share a hash; where only some of them come once more, one stands for all.
    """
    more = F.count_if(F.col("place") < F.col("extra"))
    by_hash = placed(docs, share, cap, weights, seed).groupBy("stratum", "size", "h").agg(F.first("passes").alias("passes"), F.count("*").alias("rows"), more.alias("more"))
    last = F.max(F.when(F.col("more") > 0, F.struct("h", "rows", "more")))
    cuts = written(by_hash.groupBy("stratum", "size").agg(F.first("passes").alias("passes"), last.alias("last")).select(
        F.col("stratum").alias("__stratum"), F.col("size").alias("__size"), F.col("passes").alias("__passes"),
        F.col("last.h").alias("__last"), F.col("last.rows").alias("__rows"), F.col("last.more").alias("__more")))
    small = cuts.limit(SENT + 1).count() <= SENT
    keyed = docs.withColumn("__h", row_hash(seed)).withColumn("__size", word_count()).withColumn("__stratum", stratum())
    keyed = keyed.join(F.broadcast(cuts) if small else cuts, ["__stratum", "__size"])
    split = F.coalesce((F.col("__h") == F.col("__last")) & (F.col("__more") < F.col("__rows")), F.lit(False))

    def times(rows: DataFrame, n: Column) -> DataFrame:
        counted = rows.withColumn("__n", n.cast("long")).where("__n > 0")
        return counted.withColumn("__i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__n")))).select(*docs.columns)

    copies = F.col("__passes") + F.when(F.col("__h") <= F.col("__last"), 1).otherwise(0)
    if not cuts.where("__more < __rows").limit(1).count():
        return times(keyed, copies)
    tied = written(keyed.where(split).dropDuplicates(["__h", "__size"]))
    return times(keyed.where(~split), copies).unionByName(times(tied, F.col("__passes") * F.col("__rows") + F.col("__more")))
