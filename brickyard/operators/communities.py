"""Iterative graph jobs: connected components, modularity, communities.

Each round is one written table, so plans stay short and a lost executor repeats at most one round. Neighbours are
never collected into a list; every step is a join and a partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickyard.session import written

C = F.col


def _fingerprint(edges: DataFrame):
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]


def connected_components(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(id, component) for every node of an undirected edge list (src, dst); the component is its smallest node id.

    Alternating large-star and small-star steps point every node at ever smaller nodes of its component until the
    edges form stars, in about log(n) rounds.
    """
    nodes = edges.select(C("src").alias("id")).union(edges.select(C("dst").alias("id"))).distinct()
    current = written(edges.where(C("src") != C("dst")).select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")).distinct())
    before = None
    for _ in range(max_rounds):
        both = current.unionByName(current.select(C("dst").alias("src"), C("src").alias("dst")))
        smallest = both.groupBy(C("src").alias("at")).agg(F.least(F.min("dst"), F.first("src")).alias("low"))
        large = both.join(smallest, C("src") == C("at")).where(C("dst") > C("src")).select(
            C("dst").alias("src"), C("low").alias("dst")).distinct()
        # src > dst in every edge now
        lowest = large.groupBy(C("src").alias("at")).agg(F.min("dst").alias("low"))
        small = large.join(lowest, C("src") == C("at")).where(C("dst") != C("low")).select(C("dst").alias("src"), C("low").alias("dst"))
        current = written(small.unionByName(lowest.select(C("at").alias("src"), C("low").alias("dst"))).distinct())
        mark = _fingerprint(current)
        if mark == before:
            break
        before = mark
    else:
        raise RuntimeError("components did not settle")
    return nodes.join(current.select(C("src").alias("id"), C("dst").alias("component")), "id", "left").select(
        "id", F.coalesce("component", "id").alias("component"))


def modularity(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Modularity of labels (id, community) on undirected weighted edges (src, dst, weight), each edge given once."""
    a = labels.select(C("id").alias("src"), C("community").alias("ca"))
    b = labels.select(C("id").alias("dst"), C("community").alias("cb"))
    joined = edges.join(a, "src").join(b, "dst")
    inside = joined.agg(F.sum(F.when(C("ca") == C("cb"), C("weight")).otherwise(0.0)).alias("inside"), F.sum("weight").alias("m"))
    ends = joined.select(C("ca").alias("c"), "weight").unionByName(joined.select(C("cb").alias("c"), "weight"))
    degrees = ends.groupBy("c").agg(F.sum("weight").alias("d")).agg(F.sum(C("d") * C("d"))).scalar()
    return inside.select((C("inside") / C("m") - degrees / (4 * C("m") * C("m"))).alias("modularity"))


def _moves(both: DataFrame, labels: DataFrame, total: float, turn: int | None) -> DataFrame:
    """One synchronous round: half of the nodes (by hash; all of them without a turn) go to the neighbouring community with the largest gain.

    Two single-node communities may only merge towards the smaller name, or they would swap places for ever.
    """
    target = labels.select(C("id").alias("dst"), C("community").alias("target"))
    links = both.join(target, "dst").groupBy(C("src").alias("id"), "target").agg(F.sum(F.when(C("src") != C("dst"), C("weight")).otherwise(0.0)).alias("w"))
    weights = labels.groupBy("community").agg(F.sum("degree").alias("tot"), F.count(F.lit(1)).alias("members"))
    own = labels.join(weights.select("community", C("members").alias("own_members"), C("tot").alias("own_tot")), "community")
    scored = (links.join(own, "id").join(weights.select(C("community").alias("target"), "tot", "members"), "target")
              .withColumn("mine", C("target") == C("community"))
              .withColumn("gain", C("w") - C("degree") * (C("tot") - F.when(C("mine"), C("degree")).otherwise(0.0)) / total))
    allowed = C("mine") | (C("own_members") > 1) | (C("members") > 1) | (C("target") < C("community"))
    best = scored.where(allowed).groupBy("id").agg(
        F.max_by(F.struct("target", "gain"), F.struct("gain", "mine", "target")).alias("best"),
        F.max(F.when(C("mine"), C("gain"))).alias("stay"))
    turned = F.lit(True) if turn is None else F.pmod(F.xxhash64("id", F.lit(turn)), F.lit(2)) == 0
    # a node with no link into its own community would stay at this gain
    stay = F.coalesce("stay", -C("degree") * (C("own_tot") - C("degree")) / total)
    own_tot = own.select("id", "community", "degree", "own_tot")
    return own_tot.join(best, "id", "left").select(
        "id", F.when(turned & C("best").isNotNull() & (C("best.gain") > stay + 1e-12), C("best.target")).otherwise(C("community")).alias("community"),
        "degree", C("community").alias("before"))


def communities(edges: DataFrame, max_rounds: int = 500, max_levels: int = 100) -> DataFrame:
    """(id, community) by greedy modularity: local moves, then the same on the graph of communities.

    Both run until no node would move; a limit that is met first is an error.

    Edges are undirected, (src, dst) or (src, dst, weight), each given once. A community is named by one of its nodes.
    """
    if "weight" not in edges.columns:
        edges = edges.withColumn("weight", F.lit(1.0))
    graph = written(edges.select(C("src").cast("string").alias("src"), C("dst").cast("string").alias("dst"), C("weight").cast("double").alias("weight")))
    result = None
    for level in range(max_levels):
        # both directions; a self loop counts twice towards its node's degree
        both = graph.unionByName(graph.select(C("dst").alias("src"), C("src").alias("dst"), "weight"))
        labels = written(both.groupBy(C("src").alias("id")).agg(F.sum("weight").alias("degree")).withColumn("community", C("id")))
        total = labels.agg(F.sum("degree")).first()[0]
        if not total:
            break
        moved_any = False
        for turn in range(max_rounds):
            moved = written(_moves(both, labels, total, turn + 100 * level))
            changed = not moved.where(C("community") != C("before")).isEmpty()
            labels = moved.drop("before")
            moved_any |= changed
            if not changed and _moves(both, labels, total, None).where(C("community") != C("before")).isEmpty():
                break
        else:
            raise RuntimeError("communities did not settle")
        step = labels.select("id", "community")
        if result is None:
            result = step
        else:
            up = step.select(C("id").alias("community"), C("community").alias("upper"))
            result = written(result.join(up, "community").select("id", C("upper").alias("community")))
        if not moved_any:
            break
        a, b = step.select(C("id").alias("src"), C("community").alias("ca")), step.select(C("id").alias("dst"), C("community").alias("cb"))
        graph = written(graph.join(a, "src").join(b, "dst").groupBy(F.least("ca", "cb").alias("src"), F.greatest("ca", "cb").alias("dst"))
                        .agg(F.sum("weight").alias("weight")))
    else:
        raise RuntimeError("levels of communities did not settle")
    return result


def ownership_communities(edges: DataFrame) -> DataFrame:
    """Communities of the owner-property graph: owners, properties and nodes of each."""
    pairs = edges.select(F.concat(F.lit("owner:"), "owner").alias("src"), F.concat(F.lit("property:"), "bbl").alias("dst"))
    found = communities(pairs)
    return found.groupBy("community").agg(
        F.count_if(C("id").startswith("owner:")).alias("n_owners"), F.count_if(C("id").startswith("property:")).alias("n_properties"),
        F.count(F.lit(1)).alias("total_nodes"))
