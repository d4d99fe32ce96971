"""Exact quantiles and running totals that never put a whole group into one task.

`percentile` keeps a map of every distinct value of a group in one reducer, which fails when a third of the
table belongs to one group. Here the rows are read twice, and almost nothing is shuffled:

1. histogram per (group, bucket), where the bucket is a monotone function of the value. Partial aggregation leaves at
   most 256 rows per octave and group, however many rows the group has;
2. the histogram tells which bucket holds each wanted rank; only the rows of those buckets are counted by value
   (partially first, so equal values cost nothing) and ranked;
3. a bucket with more than `FIXED` distinct values is cut anew into `STEPS` buckets between its own smallest and
   largest value, and again the ones with wanted ranks are kept, until none is too large. A step narrows a bucket
   a thousandfold, so half a dozen steps part any two doubles.

Running totals and ranks go by ranges: rows are dealt into sorted ranges of like size, stored with the number of their
range, and the ranges' totals are added up ahead of each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brickyard.session import written

_PER_OCTAVE = 256
_OFFSET = 300_000
#: Distinct values of a bucket that one window may rank, and buckets that a larger one is cut into.
FIXED, STEPS = 100_000, 1024
#: Rows of wanted buckets that are broadcast; above, rows are counted by value before they meet them.
SMALL = 200_000


def value_bucket(value: Column) -> Column:
    """Order-preserving bucket of a double: 256 steps per power of two, sign kept."""
    steps = F.floor(F.log2(F.abs(value)) * _PER_OCTAVE) + _OFFSET
    return F.when(value == 0, F.lit(0).cast("long")).otherwise((F.signum(value) * steps).cast("long"))


def _same(left: DataFrame, right: DataFrame, keys: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[prefix + k]) for k in keys])


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join where NULL keys match, keeping the left key columns."""
    renamed = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c) for c in right.columns])
    joined = left.join(renamed, _same(left, renamed, keys, "__r_"), how)
    return joined.drop(*[f"__r_{k}" for k in keys])


def exact_quantiles(df: DataFrame, keys: list[str], wanted: dict[str, tuple[str, float]]) -> DataFrame:
    """One row per group with linearly interpolated quantiles.

    `wanted` maps an output name to (value column, probability). NULL values are left out; a group in which a
    column is all NULL gets NULL. Groups with no value at all are absent (join the result to the group list).
    """
    columns = sorted({c for c, _ in wanted.values()})
    group = [*keys, "__metric"]
    if len(columns) == 1:
        long = df.select(*keys, F.lit(0).alias("__metric"), F.col(columns[0]).cast("double").alias("__value"))
    else:
        pairs = F.array(*[F.struct(F.lit(i).alias("__metric"), F.col(c).cast("double").alias("__value")) for i, c in enumerate(columns)])
        long = df.select(*keys, F.explode(pairs).alias("__pair")).select(*keys, "__pair.*")
    long = long.where(F.col("__value").isNotNull() & ~F.isnan("__value")).withColumn("__bucket", value_bucket(F.col("__value")))
    by_group = Window.partitionBy(*group)
    upto = by_group.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    probes = F.lit(None)
    for i, c in enumerate(columns):
        ranks = []
        for p in sorted({p for col, p in wanted.values() if col == c}):
            pos = F.lit(p) * (F.col("__total") - 1)
            for side, rank in ((0, F.floor(pos)), (1, F.ceil(pos))):
                ranks.append(F.struct(
                    F.lit(p).alias("p"), F.lit(side).alias("side"),
                    rank.cast("long").alias("rank"), (pos - F.floor(pos)).alias("frac"),
                ))
        probes = F.when(F.col("__metric") == i, F.array(*ranks)).otherwise(probes)

    def inside(low: Column, size: Column):
        return lambda r: (r["rank"] >= low) & (r["rank"] < low + size)

    hits = written(
        long.groupBy(*group, "__bucket").agg(F.count(F.lit(1)).alias("__size"))
        .withColumn("__before", F.coalesce(F.sum("__size").over(upto), F.lit(0)))
        .withColumn("__total", F.sum("__size").over(by_group))
        .withColumn("__hits", F.filter(probes, inside(F.col("__before"), F.col("__size"))))
        .where(F.size("__hits") > 0)
        .select(*group, "__bucket", "__before", "__size", "__hits")
    )
    known = hits.agg(F.count(F.lit(1)).alias("rows"), F.max("__size").alias("most")).first()
    place = [*group, "__bucket"]
    if known["rows"] <= SMALL:
        met = null_safe_join(long.withColumn("__n", F.lit(1).cast("long")), F.broadcast(hits), place, "inner")
    else:
        met = null_safe_join(long.groupBy(*place, "__value").agg(F.count(F.lit(1)).alias("__n")), hits, place, "inner")
    counted = met.groupBy(*place, "__value").agg(
        F.sum("__n").alias("__n"), F.first("__before").alias("__before"), F.first("__hits").alias("__hits"))
    if (known["most"] or 0) > FIXED:
        counted = _refined(counted, group, inside)
    in_bucket = Window.partitionBy(*place).orderBy("__value").rowsBetween(Window.unboundedPreceding, -1)
    found = (
        counted.withColumn("__start", F.col("__before") + F.coalesce(F.sum("__n").over(in_bucket), F.lit(0)))
        .withColumn("__hit", F.explode(F.filter("__hits", inside(F.col("__start"), F.col("__n")))))
        .select(*group, "__value", "__hit.*")
    )
    outputs = []
    for name, (c, p) in wanted.items():
        def pick(side: int, field: str, i=columns.index(c), p=p) -> Column:
            mine = (F.col("__metric") == i) & (F.col("p") == p) & (F.col("side") == side)
            return F.max(F.when(mine, F.col(field)))

        low, high = pick(0, "__value"), pick(1, "__value")
        outputs.append((low + (high - low) * pick(0, "frac")).alias(name))
    return found.groupBy(*keys).agg(*outputs)


def _refined(counted: DataFrame, group: list[str], inside) -> DataFrame:
    """Counted values of wanted buckets, cut until no bucket has more than `FIXED` values; a bucket's name is the path of its cuts."""
    place = [*group, "__bucket"]
    counted = written(counted.withColumn("__bucket", F.col("__bucket").cast("string")))
    while True:
        spans = written(counted.groupBy(*place).agg(
            F.count(F.lit(1)).alias("__values"), F.min("__value").alias("__low"), F.max("__value").alias("__high")).where(F.col("__values") > FIXED))
        if not spans.limit(1).count():
            return counted
        share = (F.col("__value") / 2 - F.col("__low") / 2) / (F.col("__high") / 2 - F.col("__low") / 2)
        cut = F.when(F.col("__values").isNull(), -1).otherwise(F.least(F.floor(share * STEPS), F.lit(STEPS - 1))).cast("int")
        cells = null_safe_join(counted, F.broadcast(spans), place).withColumn("__cut", cut).drop("__values", "__low", "__high")
        upto = Window.partitionBy(*place).orderBy("__cut").rowsBetween(Window.unboundedPreceding, -1)
        sizes = cells.groupBy(*place, "__cut").agg(
            F.sum("__n").alias("__size"), F.first("__before").alias("__from"), F.first("__hits").alias("__hits"))
        kept = (
            sizes.withColumn("__from", F.col("__from") + F.coalesce(F.sum("__size").over(upto), F.lit(0)))
            .withColumn("__hits", F.filter("__hits", inside(F.col("__from"), F.col("__size")))).where(F.size("__hits") > 0).drop("__size")
        )
        inner = null_safe_join(cells.drop("__hits", "__before"), kept, [*place, "__cut"], "inner").withColumnRenamed("__from", "__before")
        path = F.when(F.col("__cut") < 0, F.col("__bucket")).otherwise(F.concat_ws("/", "__bucket", "__cut"))
        counted = written(inner.withColumn("__bucket", path).drop("__cut"))


def aggregate_with_quantiles(
    df: DataFrame, keys: list[str], aggs: list[Column], wanted: dict[str, tuple[str, float]], exact: bool = True,
    values: DataFrame | None = None,
) -> DataFrame:
    """`groupBy(keys).agg(aggs)` plus quantile columns.

    exact=False takes the one-pass sketch (`percentile_approx`, bounded state) instead. `values` may name a cheaper
    table with the same rows (keys and value columns), so that the quantiles need not repeat the joins behind `df`.
    """
    if not exact:
        sketches = [F.percentile_approx(c, p, 10000).cast("double").alias(n) for n, (c, p) in wanted.items()]
        return df.groupBy(*keys).agg(*aggs, *sketches)
    base = df.groupBy(*keys).agg(*aggs)
    quantiles = exact_quantiles(df if values is None else values, keys, wanted)
    if not keys:  # one row on either side: a scalar subquery instead of a join
        row = quantiles.select(F.struct(*wanted)).scalar()
        return base.withColumn("__q", row).select(*base.columns, "__q.*")
    return null_safe_join(base, quantiles, keys)


def quantile_row(df: DataFrame, wanted: dict[str, tuple[str, float]]) -> dict[str, float | None]:
    """Global quantiles as one driver-side row of len(wanted) numbers."""
    row = exact_quantiles(df, [], wanted).first()
    return row.asDict() if row else dict.fromkeys(wanted)


def in_ranges(df: DataFrame, order: list[str]) -> DataFrame:
    """The rows in sorted ranges, stored, with the range's number as `__part`.

    Spark samples the bounds, so ranges have like sizes however the values lie; there are as many as shuffle partitions. The number is stored
    with the rows because every reader must see the same one.
    """
    return written(df.repartitionByRange(*order).withColumn("__part", F.spark_partition_id()))


def running_totals(df: DataFrame, order: str, totals: dict[str, str], keys: list[str] | None = None) -> DataFrame:
    """Add running sums in ascending `order`; `df` has one row per (keys, order).

    Totals of ranges are summed ahead of each one, a row per range and key, and each range is cumulated on its own, so
    neither the global order nor a large key meets in one task.
    """
    keys = keys or []
    base = in_ranges(df, [*keys, order])
    before = Window.partitionBy(*keys, F.lit(1)).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sums = base.groupBy(*keys, "__part").agg(*[F.sum(c).alias(f"__s_{out}") for out, c in totals.items()])
    offsets = sums.select(*keys, "__part", *[F.coalesce(F.sum(f"__s_{out}").over(before), F.lit(0)).alias(f"__o_{out}") for out in totals])
    inner = Window.partitionBy("__part", *keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    joined = null_safe_join(base, offsets, [*keys, "__part"], "inner")
    out = [(F.col(f"__o_{name}") + F.sum(c).over(inner)).alias(name) for name, c in totals.items()]
    return joined.select(*df.columns, *out)
