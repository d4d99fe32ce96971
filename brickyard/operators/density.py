"""Density clustering (DBSCAN), exact, without comparing all near pairs.

Rows with equal coordinates collapse to one weighted point. The grid's cells have the diagonal `eps`, so all points of a cell
are neighbours: a cell of enough weight is all core without looking at a pair, and the core points of a cell
always share a cluster. Between cells, bounding boxes decide first: a box wholly within `eps` counts as a whole, a box wholly beyond not
at all, and only boxes across the limit are split into quarters of their side, until every case is decided. A busy cell is
therefore met as a few boxes, not as its points.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brickyard.functions.quantiles import running_totals
from brickyard.operators.communities import connected_components
from brickyard.operators.segments import prepare
from brickyard.session import written

C = F.col
STEP = 4  # each refinement divides the side of a box by this


def _sum(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def _nearest(d: int, a: str, b: str) -> Column:
    """Squared distance of the nearest points of two boxes."""
    gaps = [F.greatest(F.lit(0.0), C(f"{a}lo{j}") - C(f"{b}hi{j}"), C(f"{b}lo{j}") - C(f"{a}hi{j}")) for j in range(d)]
    return _sum([g * g for g in gaps])


def _farthest(d: int, a: str, b: str) -> Column:
    spans = [F.greatest(C(f"{a}hi{j}") - C(f"{b}lo{j}"), C(f"{b}hi{j}") - C(f"{a}lo{j}")) for j in range(d)]
    return _sum([s * s for s in spans])


def _key(d: int, side: float, scale: float) -> Column:
    """Box coordinates at a refinement; scale is a power of two, so a box lies in exactly one box of each coarser level."""
    return F.array(*[F.floor(C(f"v{j}") / side * scale).cast("long") for j in range(d)])


def _boxes(points: DataFrame, d: int, key: Column, prefix: str) -> DataFrame:
    """Weight and tight bounds per (cell, box)."""
    bounds = [f(f"v{j}").alias(f"{prefix}{name}{j}") for j in range(d) for f, name in ((F.min, "lo"), (F.max, "hi"))]
    return points.groupBy(C("cell").alias(f"{prefix}cell"), key.alias(f"{prefix}key")).agg(F.sum("w").alias(f"{prefix}w"), *bounds)


def _parent(key: str) -> Column:
    return F.transform(C(key), lambda x: F.floor(x / STEP).cast("long"))


def _cell_pairs(cells: DataFrame, d: int, eps: float, side: float, lead: int = 3) -> DataFrame:
    """Ordered pairs of distinct cells whose boxes come within eps.

    Cells meet in blocks over the leading dimensions. Corners of near cells differ by less than eps + side in each, so the
    neighbouring blocks hold them all.
    """
    k = min(lead, d)
    block = eps + side
    corner = [F.floor(C("akey")[j] * side / block) for j in range(k)]
    around = cells.withColumn("at", F.array(*corner))
    for j in range(k):
        moved = [F.array(*[C("at")[i] + (step if i == j else 0) for i in range(k)]) for step in (-1, 0, 1)]
        around = around.withColumn("at", F.explode(F.array(*moved)))
    other = cells.toDF(*["b" + c[1:] for c in cells.columns]).withColumn("at", F.array(*[F.floor(C("bkey")[j] * side / block) for j in range(k)]))
    return around.join(other, "at").where((C("acell") != C("bcell")) & (_nearest(d, "a", "b") <= eps * eps)).select("acell", "bcell")


def _settle(start: DataFrame, points: DataFrame, d: int, side: float, eps: float, on_inside, done) -> None:
    """Refine undecided (probe, box) pairs. `start` holds probe columns id, alo*, ahi* and a box b*; `on_inside` receives the
    pairs wholly within eps of each round, `done` removes probes that need no more."""
    limit, scale = eps * eps, 1.0
    probe = ["id", *[f"a{n}{j}" for j in range(d) for n in ("lo", "hi")]]
    current = start
    while True:
        judged = written(current.where(_nearest(d, "a", "b") <= limit).withColumn("whole", _farthest(d, "a", "b") <= limit))
        on_inside(judged.where("whole"))
        open_pairs = done(judged.where("not whole").select(*probe, "bcell", "bkey"))
        if open_pairs.isEmpty():
            return
        scale *= STEP
        children = _boxes(points, d, _key(d, side, scale), "b").withColumn("parent", _parent("bkey"))
        current = open_pairs.withColumnRenamed("bkey", "parent").join(children, ["bcell", "parent"]).drop("parent")


def density_labels(df: DataFrame, features: list[str], eps: float = 0.5, least: int = 10) -> DataFrame:
    """Rows with `cluster` (0.. by first core point, -1 noise) and `is_core`; a border point joins its smallest cluster.

    `features` are taken as they are; a point counts as its own neighbour.
    """
    d = len(features)
    side = eps / d ** 0.5
    limit = eps * eps
    coords = [f"v{j}" for j in range(d)]
    raw = df.select(*[C(f).cast("double").alias(v) for f, v in zip(features, coords)]).groupBy(*coords).agg(F.count(F.lit(1)).alias("w"))
    keyed = written(raw.withColumn("key", _key(d, side, 1.0)))
    cells = keyed.groupBy("key").agg(F.sum("w").alias("cell_w")).withColumn("cell", F.monotonically_increasing_id())
    cells = written(cells)
    points = written(keyed.join(cells, "key").drop("key").withColumn("id", F.monotonically_increasing_id()))
    boxes = written(_boxes(points, d, _key(d, side, 1.0), "a"))
    pairs = written(_cell_pairs(boxes, d, eps, side))
    level_0 = boxes.toDF(*["b" + c[1:] for c in boxes.columns])

    def as_probe(rows: DataFrame) -> DataFrame:
        return rows.select("id", C("cell").alias("acell"), *[C(f"v{j}").alias(f"a{n}{j}") for j in range(d) for n in ("lo", "hi")])

    # 1. core points: dense cells at once, the others by counting boxes until `least` is reached
    sparse = points.where(C("cell_w") < least)
    found = [sparse.select("id", C("cell_w").alias("n"))]

    def reached() -> DataFrame:
        return reduce(DataFrame.unionByName, found).groupBy("id").agg(F.sum("n").alias("n")).where(C("n") >= least).select("id")

    _settle(as_probe(sparse).join(pairs, "acell").drop("acell").join(level_0, "bcell"), points, d, side, eps,
            lambda inside: found.append(inside.groupBy("id").agg(F.sum("bw").alias("n"))),
            lambda open_pairs: open_pairs.join(reached(), "id", "left_anti"))
    dense = points.where(C("cell_w") >= least).select("id")
    core_ids = dense.unionByName(reached()).withColumn("is_core", F.lit(1))
    points = written(points.join(core_ids, "id", "left").fillna(0, ["is_core"]))
    core = points.where("is_core = 1")

    # 2. cells with core points, linked where a core pair lies within eps
    core_boxes = written(_boxes(core, d, _key(d, side, 1.0), "a"))
    links: list[DataFrame] = []

    def linked() -> DataFrame:
        return reduce(DataFrame.unionByName, links).distinct()

    current = pairs.where(C("acell") < C("bcell")).join(core_boxes, "acell").join(core_boxes.toDF(*["b" + c[1:] for c in core_boxes.columns]), "bcell")
    scale = 1.0
    while True:
        judged = written(current.where(_nearest(d, "a", "b") <= limit).withColumn("whole", _farthest(d, "a", "b") <= limit))
        links.append(judged.where("whole").select("acell", "bcell").distinct())
        rest = judged.where("not whole").select("acell", "akey", "bcell", "bkey").join(linked(), ["acell", "bcell"], "left_anti")
        if rest.isEmpty():
            break
        scale *= STEP
        children = written(_boxes(core, d, _key(d, side, scale), "a").withColumn("aparent", _parent("akey")))
        rest = rest.withColumnsRenamed({"akey": "aparent", "bkey": "bparent"})
        current = rest.join(children, ["acell", "aparent"]).join(children.toDF(*["b" + c[1:] for c in children.columns]), ["bcell", "bparent"])
    loops = core.select(C("cell").alias("src"), C("cell").alias("dst")).distinct()
    parts = connected_components(linked().select(C("acell").alias("src"), C("bcell").alias("dst")).unionByName(loops))
    first = core.join(parts, C("cell") == parts["id"]).groupBy("component").agg(F.min(core["id"]).alias("first"))
    numbered = running_totals(first.withColumn("one", F.lit(1)), "first", {"rank": "one"})
    labels = written(parts.join(numbered, "component").select(C("id").alias("cell"), (C("rank") - 1).cast("long").alias("cluster")))

    # 3. border points: the smallest cluster with a core point within eps
    border = points.where("is_core = 0")
    own = border.select("id", "cell").join(labels, "cell").select("id", "cluster")
    reach = [own]
    core_level_0 = core_boxes.toDF(*["b" + c[1:] for c in core_boxes.columns])
    met: list[DataFrame] = []

    def remember(inside: DataFrame) -> None:
        hit = written(inside.select("id", "bcell").distinct())
        met.append(hit)
        reach.append(hit.join(labels, C("bcell") == labels["cell"]).select("id", "cluster"))

    _settle(as_probe(border).join(pairs, "acell").drop("acell").join(core_level_0, "bcell"), core, d, side, eps, remember,
            lambda open_pairs: open_pairs.join(reduce(DataFrame.unionByName, met), ["id", "bcell"], "left_anti"))
    border_label = reduce(DataFrame.unionByName, reach).groupBy("id").agg(F.min("cluster").alias("near"))
    labelled = points.join(labels, "cell", "left").join(border_label, "id", "left").select(
        *coords, "is_core", F.when(C("is_core") == 1, C("cluster")).otherwise(F.coalesce("near", F.lit(-1))).alias("cluster"))
    joined = df.withColumns({v: C(f).cast("double") for f, v in zip(features, coords)})
    return joined.join(written(labelled), coords).drop(*coords)


def fit_dbscan(df: DataFrame, eps: float = 0.5, least: int = 10, feature_set: str = "property") -> tuple[DataFrame, dict]:
    """DBSCAN of the complete rows on their standardised features, with cluster count, noise and sizes."""
    rows, features, _ = prepare(df, feature_set)
    rows = written(rows)
    out = written(density_labels(rows, [f"z_{c}" for c in features], eps, least)).drop(*[f"z_{c}" for c in features])
    totals = out.agg(F.count(F.lit(1)).alias("n"), F.count_if(C("cluster") == -1).alias("noise"), F.max("cluster").alias("last")).first()
    results = {"n_clusters": (totals["last"] if totals["last"] is not None else -1) + 1, "n_noise_points": totals["noise"],
               "noise_ratio": totals["noise"] / totals["n"] if totals["n"] else 0.0}
    return out, results
