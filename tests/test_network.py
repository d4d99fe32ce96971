import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from brickyard.operators import communities, distress, ownership


def test_edges_last_row_and_owner_cleaning(spark):
    df = spark.createDataFrame([
        (" acme llc ", "1", 10.0, dt.date(2000, 1, 1), "h"), ("ACME LLC", "1", 20.0, dt.date(2001, 1, 1), "g"), ("", "2", 1.0, None, "h"),
        ("nan", "3", 1.0, None, "h"), (None, "4", 1.0, None, "h"), ("Bob", "1", 5.0, dt.date(1999, 1, 1), None),
    ], "owner_name string, bbl string, sale_price double, sale_date date, neighborhood string")
    edges = ownership.ownership_edges(df, ["sale_date"]).orderBy("owner")
    assert [tuple(r) for r in edges.collect()] == [("ACME LLC", "1", 20.0, dt.date(2001, 1, 1)), ("BOB", "1", 5.0, dt.date(1999, 1, 1))]
    assert ownership.property_vertices(df, ["sale_date"]).collect()[0]["neighborhood"] == "g"
    assert tuple(ownership.graph_counts(edges).first()) == (2, 1, 2, 3)
    with pytest.raises(ValueError):
        ownership.ownership_edges(df.drop("owner_name"))


def _brute(members):
    hoods = {}
    for o, h in members:
        hoods.setdefault(o, set()).add(h)
    pairs = {(a, b): hoods[a] & hoods[b] for a, b in itertools.permutations(sorted(hoods), 2)}
    return hoods, {k: v for k, v in pairs.items() if v}


@pytest.mark.parametrize("seed", [0, 1])
def test_projection_against_brute_force(spark, seed):
    """One neighbourhood holds every owner; a third of the owners hold nothing else."""
    rng = random.Random(seed)
    members = {(f"o{i:02d}", "hot") for i in range(40)}
    members |= {(f"o{i:02d}", f"h{rng.randrange(8)}") for i in range(14, 40) for _ in range(rng.randrange(1, 7))}
    df = spark.createDataFrame(sorted(members), "owner string, neighborhood string")
    hoods, pairs = _brute(members)
    degrees = {r["owner"]: (r["n_neighborhoods"], r["weighted_degree"]) for r in ownership.projection_degrees(df).collect()}
    assert degrees == {o: (len(h), sum(len(v) for (a, _), v in pairs.items() if a == o)) for o, h in hoods.items()}
    chosen = spark.createDataFrame([("o01",), ("o20",)], "owner string")
    links = {(r["owner_a"], r["owner_b"]): set(r["shared_neighborhoods"]) for r in ownership.owner_links(df, chosen).collect()}
    assert links == {k: v for k, v in pairs.items() if k[0] in ("o01", "o20")}
    for least, top in ((1, 30), (3, 50), (2, 7)):
        want = sorted(((-len(v), a, b) for (a, b), v in pairs.items() if len(v) >= least))[:top]
        got = [(-r["shared_neighborhoods"], r["owner_a"], r["owner_b"]) for r in ownership.co_investment(df, least, top).collect()]
        assert sorted(got) == want


def test_sellers_and_flow(spark):
    deeds = spark.createDataFrame([
        ("B", "S", "1", dt.date(2001, 5, 1)), ("B", "S", "2", dt.date(1990, 1, 1)), ("C", "T", "3", dt.date(2001, 6, 1)), ("C", "S", "3", dt.date(2001, 6, 1)),
    ], "buyer string, seller string, bbl string, sale_date date")
    owned = spark.createDataFrame([("S", "1"), ("S", "9"), ("U", "8")], "owner string, bbl string")
    assert [tuple(r) for r in ownership.likely_sellers(owned, deeds, dt.date(2001, 12, 31)).collect()] == [("S", "9", 2)]
    props = spark.createDataFrame([("1", "x", 10.0), ("2", "y", 20.0), ("3", "x", 5.0)], "bbl string, neighborhood string, assesstot double")
    held = deeds.select(F.col("buyer").alias("owner"), "bbl").distinct()
    flow = {(r[0], r[1]): (r[2], r[3]) for r in ownership.investment_flow(deeds, held, props).collect()}
    # C buys property 3 with two sellers twice over (two deeds, two sellers) and holds nothing elsewhere
    assert flow == {("y", "x"): (1, 10.0), ("x", "y"): (1, 20.0), (None, "x"): (4, 20.0)}


def test_components(spark):
    chain = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(60)]
    random.Random(5).shuffle(chain)
    star = [("z0", f"z{i}") for i in range(1, 30)]
    got = {r["id"]: r["component"] for r in communities.connected_components(spark.createDataFrame(chain + star + [("q", "q")], "src string, dst string")).collect()}
    assert {v for k, v in got.items() if k.startswith("n")} == {"n000"}
    assert {v for k, v in got.items() if k.startswith("z")} == {"z0"} and got["q"] == "q"
    assert len(got) == 61 + 30 + 1


def test_communities_of_two_cliques(spark):
    def clique(prefix):
        return list(itertools.combinations([f"{prefix}{i}" for i in range(6)], 2))

    edges = spark.createDataFrame(clique("a") + clique("b") + [("a0", "b0")], "src string, dst string")
    labels = communities.communities(edges)
    got = {r["id"]: r["community"] for r in labels.collect()}
    assert len({got[f"a{i}"] for i in range(6)}) == 1 and len(set(got.values())) == 2
    weighted = edges.withColumn("weight", F.lit(1.0))
    score = communities.modularity(weighted, labels).first()[0]
    assert score == pytest.approx(30 / 31 - 2 * (31 ** 2) / (4 * 31 ** 2))
    alone = labels.withColumn("community", F.col("id"))
    assert score > communities.modularity(weighted, alone).first()[0]


def test_propensity_edges(spark):
    df = spark.createDataFrame([("A", "h", dt.date(2001, 1, 1), 0.5, 60.0, 0), ("B", "h", None, 1.0, 10.0, 1), ("B", "h", None, None, None, 0)],
                               "owner string, neighborhood string, sale_date date, price_vs_neighborhood double, building_age double, is_recently_renovated int")
    out = distress.propensity_to_sell(df).orderBy(F.desc("propensity_to_sell_score")).collect()
    assert [round(r["propensity_to_sell_score"], 2) for r in out] == [0.8, 0.0, 0.0]
    assert [r["sell_likelihood"] for r in out] == ["High", None, None]


def test_unsettled_communities_are_an_error(spark):
    chain = spark.createDataFrame([(f"n{i:02d}", f"n{i + 1:02d}") for i in range(24)], "src string, dst string")
    with pytest.raises(RuntimeError):
        communities.communities(chain, max_rounds=1)


def test_links_pair_sets_and_shuffle_no_pairs(spark):
    """One busy neighbourhood: no row per owner pair and neighbourhood, and nothing is grouped by pairs."""
    members = spark.createDataFrame([(f"o{i}", h) for i in range(30) for h in ("hot", f"h{i % 3}")] + [("alone", "far"), ("lost", None)], "owner string, neighborhood string")
    links = ownership.owner_links(members, spark.createDataFrame([("o0",), ("alone",), ("lost",)], "owner string"))
    assert "hashpartitioning(owner_a" not in links._jdf.queryExecution().executedPlan().toString()
    got = {(r["owner_a"], r["owner_b"]): (r["weight"], r["shared_neighborhoods"]) for r in links.collect()}
    assert got == {("o0", f"o{i}"): (2, ["h0", "hot"]) if i % 3 == 0 else (1, ["hot"]) for i in range(1, 30)}
    assert links.schema["weight"].dataType.simpleString() == "bigint"
