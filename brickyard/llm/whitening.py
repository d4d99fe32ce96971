"""Embedding whitening by polarisation covariance.

Entries become integers. Tasks add up exact squares of the centred values of every dimension and of the sum of every pair of dimensions; as
Var(a + b) = Var(a) + Var(b) + 2 Cov(a, b), differences of these variances give every cross-covariance without a product of two dimensions. The
assembled matrix, dims x dims whatever the table, goes to eigh, and tasks project the rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brickyard.session import written

#: Values whose squares, of pair sums too, int64 adds up over a block without overflow: 2 * (2 ** 24) squared over 2 ** 12 rows.
SAFE, BLOCK = 1 << 24, 1 << 12
#: Shift and scale of the integers.
SHIFT, SCALE = 1_000_000, 64
#: Entries from here on stop the job.
LARGEST = 1 << 56
RESULT = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"


def complete(vector: Column) -> Column:
    """A vector of one entry at least, without null, NaN and infinity."""
    wide = vector.cast("array<double>")
    return F.coalesce((F.size(wide) > 0) & F.forall(wide, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))), F.lit(False))


def integers(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, x) of the complete vectors of the commonest length (ties: the longest)."""
    kept = vectors.where(complete(F.col(vector))).select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    common = kept.groupBy(F.size("v").alias("dims")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("dims")).first()
    too_large = F.raise_error(F.lit("an entry of 2**56 or more has no exact integer")).cast("long")
    x = F.transform("v", lambda c: F.when(F.abs(c) < float(LARGEST), F.floor(c * SCALE) + SHIFT).otherwise(too_large))
    return kept.where(F.size("v") == (common["dims"] if common else 0)).select("vec_id", x.alias("x"))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists all have one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            yield part, matrix(part.column("x"))


def sums(fit: DataFrame, measure: Callable[[np.ndarray], dict[str, np.ndarray]], names: list[str]) -> dict[str, np.ndarray]:
    """Exact totals over all tasks of the integer arrays that `measure` gives for a block; one row per task, name and place is added up in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for _, x in blocks(batches):
            for name, values in measure(x).items():
                total[name] = total[name] + values if name in total else values.astype(object)
        for name, values in total.items():
            yield pa.record_batch({"name": pa.array([name] * len(values)), "place": pa.array(range(len(values)), pa.int32()),
                                   "value": pa.array([int(v) for v in values], pa.decimal128(38, 0))})

    rows = fit.mapInArrow(run, "name string, place int, value decimal(38,0)").groupBy("name", "place").agg(F.sum("value").alias("value")).collect()
    found: dict[str, dict[int, int]] = {name: {} for name in names}
    for row in rows:
        found[row["name"]][row["place"]] = int(row["value"])
    return {name: np.array([values[i] for i in range(len(values))], object) for name, values in found.items()}


def wide(values: np.ndarray) -> np.ndarray:
    """int64 where squares of pair sums of a block surely fit, else Python integers."""
    return values if not values.size or int(np.abs(values).max()) < SAFE else values.astype(object)


def first_moments(x: np.ndarray) -> dict[str, np.ndarray]:
    near = wide(x - SHIFT)
    return {"n": np.array([len(x)]), "sum": near.sum(axis=0)}


def squares(middle: np.ndarray, x: np.ndarray) -> dict[str, np.ndarray]:
    """Sums of z, of z squared per dimension and of (z_i + z_j) squared per pair i < j, for z = x less the rounded mean."""
    z = np.ascontiguousarray(wide(x - middle).T)
    pairs = [((z[i + 1:] + z[i]) ** 2).sum(axis=1) for i in range(len(z) - 1)]
    return {"z": z.sum(axis=1), "own": (z * z).sum(axis=1), "pair": np.concatenate(pairs) if pairs else np.empty(0, np.int64)}


@dataclass
class Whitening:
    """What a fit knows: rows, exact sums around the rounded mean, eigenvalues and vectors (columns), trace."""

    n: int
    middle: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def sure(self) -> np.ndarray:
        """Components whose variance isn't rounding only."""
        return self.values > max(self.values[:1].max(initial=0.0), 0.0) * len(self.middle) * 2.0 ** -50


def covariance(n: int, z: np.ndarray, own: np.ndarray, pair: np.ndarray) -> np.ndarray:
    """Covariances, each rounded once from its exact fraction: n**2 Var = n * sum of squares - square of the sum."""
    dims = len(z)
    variance = [n * own[i] - z[i] ** 2 for i in range(dims)]
    out = np.empty((dims, dims))
    at = 0
    for i in range(dims):
        out[i, i] = float(Fraction(variance[i], n * n))
        for j in range(i + 1, dims):
            both = n * pair[at] - (z[i] + z[j]) ** 2
            out[i, j] = out[j, i] = float(Fraction(both - variance[i] - variance[j], 2 * n * n))
            at += 1
    return out


def fit_whitening(fit: DataFrame, components: int = 16) -> Whitening | None:
    """Whitening learnt from the distinct integer vectors `x` of `fit`; None if there is none."""
    first = sums(fit, first_moments, ["n", "sum"])
    if not len(first["n"]):
        return None
    n = int(first["n"][0])
    middle = np.array([(2 * int(s) + n) // (2 * n) + SHIFT for s in first["sum"]], np.int64)
    second = sums(fit, lambda x: squares(middle, x), ["z", "own", "pair"])
    cov = covariance(n, second["z"], second["own"], second["pair"])
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    found = Whitening(n, middle, second["z"], values, vectors, float(np.trace(cov)), 0.0)
    good = found.sure()
    if good.any():
        found.identity_error = measured_error(fit, found, good)
    return found


def projected(model: Whitening, z: np.ndarray) -> np.ndarray:
    """Whitened coordinates of rows z = x - middle; NaN where a component has no variance."""
    rest = np.array([float(Fraction(int(r), model.n)) for r in model.rest])
    good = model.sure()
    scale = np.where(good, 1 / np.sqrt(np.where(good, model.values, 1.0)), np.nan)
    return (z.astype(float) - rest) @ model.vectors * scale


def measured_error(fit: DataFrame, model: Whitening, good: np.ndarray) -> float:
    """Largest entry of the whitened rows' covariance less the identity, from the rows themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = int(good.sum())
        total, n = np.zeros((k + 1, k)), 0
        for _, x in blocks(batches):
            y = projected(model, x - model.middle)[:, good]
            total += np.vstack([y.T @ y, y.sum(axis=0)])
            n += len(y)
        yield pa.record_batch({"place": pa.array(range(total.size), pa.int32()), "value": total.ravel()})

    rows = fit.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    k = int(good.sum())
    total = np.zeros((k + 1) * k)
    for row in rows:
        total[row["place"]] = row["value"]
    total = total.reshape(k + 1, k) / model.n
    return float(np.abs(total[:k] - np.outer(total[k], total[k]) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 16, vector: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error, deviation_exact: one row per kept vector and component.

    Vectors that are null, empty or hold null or non-finite entries go, and so do those of another length than the commonest one. Every remaining row is returned,
    repeated ids and vectors too; the fit takes each integer vector once, so a vector that a third of all rows share weighs as one. `deviation` is null where it
    exceeds a long (its exact value is in `deviation_exact`). A component without variance (fewer distinct vectors than dimensions, constant entries) has a null
    `whitened` and isn't part of `identity_error`; with a single distinct vector all are, and `explained` is null. Entries of 2**56 and more stop the
    job. An empty table gives an empty result; other columns are ignored. The distinct vectors are stored once in the checkpoint folder; a task holds 4,096 rows.
    """
    spark = vectors.sparkSession
    rows = integers(vectors, vector)
    fit = written(rows.select("x").distinct())
    model = fit_whitening(fit, components)
    if model is None:
        return spark.createDataFrame([], RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit = math.isqrt((1 << 62) // (len(model.middle) * model.n * model.n)) - 1 if model.n < 1 << 31 else 0
        for part, x in blocks(batches):
            z = x - model.middle
            exact = z * model.n - model.rest.astype(np.int64) if z.size and int(np.abs(z).max()) < limit else z.astype(object) * model.n - model.rest
            square = (exact * exact).sum(axis=1)
            y = projected(model, z)
            yield pa.record_batch({
                "vec_id": part.column("vec_id"), "deviation_exact": pa.array([int(s) for s in square], pa.decimal128(38, 0)),
                "w": pa.ListArray.from_arrays(np.arange(0, y.size + 1, y.shape[1], dtype=np.int32), pa.array(y.ravel(), mask=np.isnan(y.ravel()))),
            })

    coded = rows.mapInArrow(run, "vec_id bigint, deviation_exact decimal(38,0), w array<double>")
    share = model.values / model.trace if model.trace > 0 else np.full(len(model.values), np.nan)
    explained = F.array(*[F.lit(None if math.isnan(s) else float(s)).cast("double") for s in share])
    long = F.when(F.col("deviation_exact") <= F.lit((1 << 63) - 1).cast("decimal(38,0)"), F.col("deviation_exact").cast("long"))
    return coded.select("vec_id", "deviation_exact", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), long.alias("deviation"), "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(model.identity_error).alias("identity_error"), "deviation_exact",
    )
