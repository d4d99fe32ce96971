"""Near-duplicate vectors by spherical-cap filters with structured random product codes (Becker, Ducas, Gama, Laarhoven 2016).

Filter directions are all concatenations of unit code words, one per block of dimensions, after a random rotation. A vector joins the filters of each code whose
directions are nearest to it, so its caps are as high as its own place in the code allows and no vector joins too few; the code's structure lets it find them
block by block without trying all. Vectors of a filter are verified against each other in double precision. The number of filters grows with the number of
vectors, so a filter of spread-out vectors keeps `PER_FILTER` of them at any size, and how many a vector joins is chosen for a stated miss rate at that size.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brickyard.llm.common import components
from brickyard.session import written

#: Vectors that a filter holds, on average over spread-out vectors.
PER_FILTER = 16
#: Independent codes, and the share of pairs just at the threshold that may meet in none of their filters, at any number of rows.
CODES, MISS = 8, 1e-4
#: Random pairs on which a code's recall is measured.
TRIALS = 400
#: Code words per block up to which two blocks do.
WORDS_OF_TWO = 4096
#: Vectors of a filter that meet in one cell; a larger filter is cut into parts, and each pair of parts is a cell.
CELL = 1000


def code(dims: int, vectors: int, best: int, number: int, seed: int = 29) -> tuple[np.ndarray, list[np.ndarray]]:
    """The rotation and each block's code words of one of the codes, for so many vectors that join their `best` filters of it."""
    filters = max(best, math.ceil(vectors * best / PER_FILTER))
    blocks = max(1, min(dims, 2 if filters <= WORDS_OF_TWO ** 2 else 3))
    size = max(2, math.ceil(filters ** (1 / blocks)))
    random = np.random.default_rng([seed, dims, number])
    q, r = np.linalg.qr(random.normal(size=(dims, dims)))
    words = []
    for part in np.array_split(np.arange(dims), blocks):
        w = random.normal(size=(size, len(part)))
        words.append(w / np.linalg.norm(w, axis=1, keepdims=True))
    return q * np.sign(np.diag(r)), words


def nearest(x: np.ndarray, rotation: np.ndarray, words: list[np.ndarray], best: int) -> np.ndarray:
    """The `best` filters of each unit row of `x`, built block by block: a direction among the best of all begins with one among the best of its first blocks."""
    x = x @ rotation
    name, sofar = np.zeros((len(x), 1), np.int64), np.zeros((len(x), 1))
    edges = np.cumsum([0, *(w.shape[1] for w in words)])
    for (a, b), w in zip(itertools.pairwise(edges), words, strict=True):
        scores = x[:, a:b] @ w.T
        some = top(scores, best)
        name = (name[:, :, None] * len(w) + some[:, None, :]).reshape(len(x), -1)
        sofar = (sofar[:, :, None] + np.take_along_axis(scores, some, axis=1)[:, None, :]).reshape(len(x), -1)
        some = top(sofar, best)
        name, sofar = np.take_along_axis(name, some, axis=1), np.take_along_axis(sofar, some, axis=1)
    return name


def top(scores: np.ndarray, n: int) -> np.ndarray:
    """Places of the `n` largest of each row."""
    n = min(n, scores.shape[1])
    return np.argpartition(scores, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n:]


def codes_for(dims: int, vectors: int, threshold: float) -> tuple[int, list[tuple[np.ndarray, list[np.ndarray]]]]:
    """How many filters of each code a vector joins, and the codes, so that at most the share `MISS` of pairs at the threshold meets nowhere.

    A pair's filters don't depend on other vectors, and a random rotation makes all pairs of one cosine alike and the codes independent; so the share that one code
    misses, measured on random pairs with the very codes, counts to the power of `CODES`.
    """
    random = np.random.default_rng([31, dims])
    x, y = random.normal(size=(2, TRIALS, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y -= (x * y).sum(axis=1, keepdims=True) * x
    y /= np.maximum(np.linalg.norm(y, axis=1, keepdims=True), 1e-300)
    y = threshold * x + math.sqrt(max(0.0, 1 - threshold ** 2)) * y
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    best = 1
    while True:
        codes = [code(dims, vectors, best, number) for number in range(CODES)]
        met = [(nearest(x, *one, best)[:, :, None] == nearest(y, *one, best)[:, None, :]).any(axis=(1, 2)) for one in codes]
        if (1 - np.mean(met)) ** CODES <= MISS:
            return best, codes
        best += max(1, best // 4)


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal length as a matrix in double precision; null components are NaN."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def linkable() -> Column:
    """Not null, not zero, all components finite."""
    v = F.col("embedding")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & (F.size(v) > 0) & F.exists(v, lambda x: x != 0)
    return F.coalesce(fine, F.lit(False))


def joined_filters(vectors: DataFrame, dims: int, n: int, threshold: float = 0.95) -> DataFrame:
    """rep, weight, embedding, filters of vectors with `dims` dimensions."""
    sent = vectors.sparkSession.sparkContext.broadcast(codes_for(dims, n, threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            x = matrix(part.column("embedding"))
            x /= np.abs(x).max(axis=1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            best, codes = sent.value
            name = np.concatenate([nearest(x, *one, best) * CODES + number for number, one in enumerate(codes)], axis=1)
            ends = (np.arange(len(x) + 1) * name.shape[1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("rep"), part.column("weight"), part.column("embedding"), pa.ListArray.from_arrays(pa.array(ends), pa.array(name.ravel()))],
                                             ["rep", "weight", "embedding", "filters"])

    kind = vectors.schema["embedding"].dataType.simpleString()
    return vectors.mapInArrow(run, f"rep long, weight long, embedding {kind}, filters array<long>")


def cells(rows: DataFrame) -> DataFrame:
    """One row per filter and part pair of a vector: cell (filter, i, j) holds parts i and j of the filter. Of the vector's filters only smaller ones go along."""
    opened = rows.select("rep", "weight", "embedding", "filters", F.explode("filters").alias("filter"))
    opened = opened.withColumn("filters", F.filter("filters", lambda f: f < F.col("filter")))
    sizes = rows.select(F.explode("filters").alias("filter")).groupBy("filter").agg(F.count("*").alias("n")).where("n > 1")
    parts = sizes.select("filter", F.ceil(F.col("n") / CELL).cast("int").alias("parts"))
    mine = opened.join(parts, "filter").withColumn("part", F.pmod(F.xxhash64("rep", "filter"), F.col("parts")).cast("int"))
    others = mine.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return others.select("filter", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", "rep", "weight", "embedding", "filters")


def verify(threshold: float):
    """Per cell: for each vector the weight of its links that belong to this filter (the smallest that both share), and one edge to a linked vector."""

    def run(cell: pa.Table) -> pa.Table:
        cell = cell.combine_chunks()
        i, j = cell.column("i")[0].as_py(), cell.column("j")[0].as_py()
        own = cell.column("filter")[0].as_py()
        part, rep, weight = (cell.column(c).to_numpy() for c in ("part", "rep", "weight"))
        x = matrix(cell.column("embedding").chunk(0))
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        lists = cell.column("filters").chunk(0)
        ends = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        flat = lists.flatten().to_numpy()
        left, right = np.flatnonzero(part == i), np.flatnonzero(part == j)
        near = x[left] @ x[right].T >= threshold
        if i == j:
            np.fill_diagonal(near, False)
        name, times = np.unique(flat[flat < own], return_counts=True)
        name = name[times > 1]
        member = np.zeros((len(rep), len(name)), np.float32)
        at = np.searchsorted(name, flat)
        known = np.flatnonzero(np.append(name, -1)[at] == flat)
        member[np.searchsorted(ends, known, side="right") - 1, at[known]] = 1
        mine = near & (member[left] @ member[right].T == 0)
        count, label = np.zeros(len(rep), np.int64), np.arange(len(rep))
        count[left] = mine @ weight[right]
        if i != j:
            count[right] = weight[left] @ mine
        while near.any():
            before = label.copy()
            label[left] = np.minimum(label[left], np.where(near, label[right][None, :], len(label)).min(axis=1))
            label[right] = np.minimum(label[right], np.where(near, label[left][:, None], len(label)).min(axis=0))
            if (label == before).all():
                break
        told = np.flatnonzero((count > 0) | (label != np.arange(len(label))))
        return pa.table({"rep": rep[told], "n": count[told], "root": rep[label[told]]})

    return run


def near_duplicates(vectors: DataFrame, threshold: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of `vectors`.

    Links have a cosine of at least `threshold` in double precision; the filters miss at most about the share `MISS` of those just at the threshold,
    fewer of nearer ones, and give none below.
    n_links counts other rows linked directly, component_id is the smallest vec_id reachable, kept tells whether the row is that one. Vectors that are null, empty, zero or
    hold null or non-finite components link with nothing: component_id is their own id. Vectors of different lengths don't link. Equal vectors are one class: they
    are verified once and counted with their number. Rows without an id count as links but name no component. An empty table gives an empty result; other columns
    are ignored. Pairs are never listed: a filter hands on a count and an edge per vector.
    """
    valid = vectors.where(linkable()).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    grouped = valid.groupBy("embedding").agg(F.count("*").alias("weight"), F.min("vec_id").alias("least"))
    reps = written(grouped.withColumn("rep", F.monotonically_increasing_id()))
    shapes = reps.groupBy(F.size("embedding").alias("dims")).count().collect()
    found = None
    for shape in sorted(shapes):
        mine = reps.where(F.size("embedding") == shape["dims"]).select("rep", "weight", "embedding")
        rows = written(joined_filters(mine, shape["dims"], shape["count"], threshold))
        near = cells(rows).groupBy("filter", "i", "j").applyInArrow(verify(threshold), "rep long, n long, root long")
        found = near if found is None else found.unionByName(near)
    ids = F.col("vec_id").cast("long").alias("vec_id")
    if found is None:
        return vectors.select(ids, F.lit(0).cast("long").alias("n_links"), ids.alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    found = written(found)
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    labels = components(found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    named = reps.join(counts, "rep", "left").join(labels, F.col("rep") == F.col("id"), "left").withColumn("label", F.coalesce("component_id", "rep")).drop("component_id")
    smallest = named.groupBy("label").agg(F.min("least").alias("component_id"))
    told = named.join(smallest, "label").select(F.col("embedding").alias("__e"), (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("links"), "component_id")
    out = valid.withColumnRenamed("embedding", "__own").join(told, F.col("__own") == F.col("__e")).select("vec_id", F.col("links").cast("long").alias("n_links"), "component_id")
    rest = vectors.where(~linkable()).select(ids, F.lit(0).cast("long").alias("n_links"), ids.alias("component_id"))
    return out.unionByName(rest).withColumn("kept", F.col("vec_id").isNotNull() & F.col("vec_id").eqNullSafe(F.col("component_id")))


ORACLE = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND list_aggregate(list_transform(embedding, lambda x: CASE WHEN isfinite(x) THEN 0 ELSE 1 END), 'sum') = 0),
n AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS length FROM v),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM n AS x JOIN n AS y ON x.vec_id <> y.vec_id AND x.length > 0 AND y.length > 0
    AND list_dot_product(x.e, y.e) >= 0.95 * x.length * y.length),
r AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
k AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT c.a AS vec_id, coalesce(k.n_links, 0) AS n_links, c.component_id, c.a = c.component_id AS kept FROM c LEFT JOIN k ON k.a = c.a
"""
