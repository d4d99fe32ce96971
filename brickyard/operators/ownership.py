"""Ownership network: owner-property edges, portfolios, shared neighbourhoods, transfers.

The owner-owner projection has one edge per pair of owners in a neighbourhood, so writing it out grows with the square
of the busiest neighbourhood. Every result here is computed without that list: degrees come from neighbourhood sizes,
the links of chosen owners from a join with the memberships, and the top pairs from a prefix-filtered join of distinct
neighbourhood sets.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brickyard import settings
from brickyard.functions.scalars import has, haversine_km
from brickyard.operators.distress import owner_column
from brickyard.session import written

C = F.col
PROPERTY_ATTRIBUTES = ["borough_name", "neighborhood", "assesstot", "bldgarea", "latitude", "longitude"]


def clean_owner(df: DataFrame, owner: str) -> DataFrame:
    """Rows with a usable upper-case owner name; blanks and 'NAN' are skipped."""
    name = F.upper(F.trim(C(owner).cast("string")))
    return df.withColumn("owner", name).where(C("owner").isNotNull() & ~C("owner").isin("", "NAN"))


def ownership_edges(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One edge per owner and property; the last row in `order` gives the sale attributes.

    `max_by` keeps one candidate per task, so a property or owner with many sales shuffles few rows.
    """
    owner = owner_column(df)
    if owner is None:
        raise ValueError("no owner column")
    rows = clean_owner(df, owner)
    kept = [c for c in ("sale_price", "sale_date") if has(rows, c)]
    if not kept:
        return rows.select("owner", "bbl").distinct()
    last = F.max_by(F.struct(*kept), F.struct(*(order or kept))).alias("last")
    return rows.groupBy("owner", "bbl").agg(last).select("owner", "bbl", *[C(f"last.{c}").alias(c) for c in kept])


def property_vertices(df: DataFrame, order: list[str] | None = None) -> DataFrame:
    """One row per owned property with the attributes of its last row."""
    owner = owner_column(df)
    rows = clean_owner(df, owner) if owner else df
    kept = [c for c in PROPERTY_ATTRIBUTES if has(rows, c)]
    keys = order or [c for c in ("sale_date", "sale_price") if has(rows, c)] or kept
    return rows.groupBy("bbl").agg(F.max_by(F.struct(*kept), F.struct(*keys, *(c for c in kept if c not in keys))).alias("last")).select("bbl", *[C(f"last.{c}").alias(c) for c in kept])


def graph_counts(edges: DataFrame) -> DataFrame:
    owners, properties = edges.select("owner").distinct(), edges.select("bbl").distinct()
    one = edges.agg(F.count(F.lit(1)).alias("n_edges"))
    return one.select(owners.agg(F.count(F.lit(1))).scalar().alias("n_owners"), properties.agg(F.count(F.lit(1))).scalar().alias("n_properties"), "n_edges") \
        .withColumn("n_nodes", C("n_owners") + C("n_properties"))


def edges_from_csv(spark, path: str) -> DataFrame:
    """Owner-property edges of a CSV file with header (ownername, bbl and optional attributes)."""
    rows = spark.read.option("header", True).csv(path)
    return clean_owner(rows, "ownername").select("owner", "bbl").distinct()


# --- portfolios -----------------------------------------------------------
def memberships(edges: DataFrame, properties: DataFrame) -> DataFrame:
    """Distinct (owner, neighborhood); a property without one counts as 'Unknown'."""
    hoods = properties.select("bbl", F.coalesce("neighborhood", F.lit("Unknown")).alias("neighborhood"))
    return edges.select("owner", "bbl").join(hoods, "bbl").select("owner", "neighborhood").distinct()


def portfolios(edges: DataFrame, properties: DataFrame) -> DataFrame:
    """Property count, total assessed value and neighbourhood count of every owner."""
    attrs = properties.select("bbl", F.coalesce("assesstot", F.lit(0.0)).alias("assesstot"))
    size = edges.join(attrs, "bbl").groupBy("owner").agg(
        F.count(F.lit(1)).alias("n_properties"), F.sum("assesstot").alias("portfolio_value"))
    spread = memberships(edges, properties).groupBy("owner").agg(F.count(F.lit(1)).alias("n_neighborhoods"))
    return size.join(spread, "owner")


def largest_portfolios(edges: DataFrame, properties: DataFrame, top: int = 20) -> DataFrame:
    attrs = properties.select("bbl", F.coalesce("assesstot", F.lit(0.0)).alias("assesstot"))
    return edges.join(attrs, "bbl").groupBy("owner").agg(
        F.count(F.lit(1)).alias("n_properties"), F.sum("assesstot").alias("portfolio_value")
    ).orderBy(F.desc("portfolio_value"), "owner").limit(top)


def key_players(edges: DataFrame, properties: DataFrame, top: int = 20, centrality: DataFrame | None = None) -> DataFrame:
    """The owners of the largest portfolios with spread, first five neighbourhoods and degree centrality.

    `centrality` (owner, betweenness) of the projection adds `betweenness_centrality`, 0 for owners that it lacks.
    """
    nodes = graph_counts(edges).select("n_nodes").scalar()
    best = portfolios(edges, properties).orderBy(F.desc("portfolio_value"), "owner").limit(top)
    named = memberships(edges, properties).join(best.select("owner"), "owner", "left_semi")
    first = Window.partitionBy("owner").orderBy("neighborhood")
    names = (named.withColumn("r", F.row_number().over(first)).where("r <= 5").groupBy("owner")
             .agg(F.array_sort(F.collect_list("neighborhood")).alias("neighborhoods")))
    out = best.join(names, "owner").withColumn("degree_centrality", C("n_properties") / (nodes - 1))
    if centrality is not None:
        out = out.join(centrality.select("owner", C("betweenness").alias("betweenness_centrality")), "owner", "left").fillna(0.0, ["betweenness_centrality"])
    return out.orderBy(F.desc("portfolio_value"), "owner")


# --- owner-owner projection -------------------------------------------------
def projection_degrees(members: DataFrame) -> DataFrame:
    """Per owner: neighbourhoods held and the sum of edge weights in the projection, i.e. over its neighbourhoods the
    number of other owners there."""
    sizes = members.groupBy("neighborhood").agg((F.count(F.lit(1)) - 1).alias("others"))
    return members.join(sizes, "neighborhood").groupBy("owner").agg(
        F.count(F.lit(1)).alias("n_neighborhoods"), F.sum("others").alias("weighted_degree"))


def owner_links(members: DataFrame, owners: DataFrame) -> DataFrame:
    """Projection edges of the given owners: partner, weight and the shared neighbourhoods.

    The result has at most |owners| x |all owners| rows; pass a short list.
    """
    sets = members.where(C("neighborhood").isNotNull()).groupBy("owner").agg(F.array_sort(F.collect_list("neighborhood")).alias("hoods"))
    mine = written(sets.join(owners.select("owner"), "owner", "left_semi").toDF("owner_a", "hoods_a"))
    shared = F.filter("hoods", lambda h: F.array_contains("hoods_a", h))
    return (sets.withColumnRenamed("owner", "owner_b").join(mine, C("owner_a") != C("owner_b"))
            .select("owner_a", "owner_b", F.size(shared).cast("long").alias("weight"), shared.alias("shared_neighborhoods")).where(C("weight") > 0))


def neighborhood_sets(members: DataFrame, names: int) -> DataFrame:
    """Owners grouped by identical neighbourhood set: set id, the sorted set, member count and the first `names` owners.

    Equal sets collapse, so the many owners of a single busy neighbourhood become one row.
    """
    sets = members.groupBy("owner").agg(F.array_sort(F.collect_list("neighborhood")).alias("hoods"))
    sizes = sets.groupBy("hoods").agg(F.min("owner").alias("set_id"), F.count(F.lit(1)).alias("n_owners"))
    first = Window.partitionBy("hoods").orderBy("owner")
    few = (sets.withColumn("r", F.row_number().over(first)).where(C("r") <= names).groupBy("hoods")
           .agg(F.array_sort(F.collect_list("owner")).alias("owners")))
    return sizes.join(few, "hoods").withColumn("size", F.size("hoods"))


def set_overlaps(sets: DataFrame, tokens: DataFrame, at_least: int) -> DataFrame:
    """Pairs of neighbourhood sets that share at least `at_least` neighbourhoods, with the number of owner pairs.

    Prefix filter: with tokens ordered from rare to common, two sets sharing t tokens meet in their first size - t + 1
    tokens, so the commonest neighbourhoods of each set are never joined on.
    """
    big = sets.where(C("size") >= at_least)
    ranked = tokens.join(big.select("set_id", "size"), "set_id").withColumn(
        "r", F.row_number().over(Window.partitionBy("set_id").orderBy("frequency", "neighborhood")))
    prefix = ranked.where(C("r") <= C("size") - at_least + 1).select("set_id", "neighborhood")
    left, right = prefix.withColumnRenamed("set_id", "a"), prefix.withColumnRenamed("set_id", "b")
    meets = left.join(right, "neighborhood").where(C("a") < C("b")).select("a", "b").distinct()
    side = big.select("set_id", "hoods", "n_owners", "owners")
    pairs = (meets.join(side.toDF("a", "hoods_a", "n_a", "owners_a"), "a").join(side.toDF("b", "hoods_b", "n_b", "owners_b"), "b")
             .withColumn("shared", F.array_intersect("hoods_a", "hoods_b")).where(F.size("shared") >= at_least)
             .select(F.size("shared").alias("weight"), F.array_sort("shared").alias("neighborhoods"), (C("n_a") * C("n_b")).alias("n_pairs"), "owners_a", "owners_b"))
    same = big.where(C("n_owners") > 1).select(
        C("size").alias("weight"), C("hoods").alias("neighborhoods"), (C("n_owners") * (C("n_owners") - 1) / 2).cast("long").alias("n_pairs"),
        C("owners").alias("owners_a"), C("owners").alias("owners_b"))
    return pairs.unionByName(same)


def co_investment(members: DataFrame, min_shared: int = 3, top: int = 50, both_ways: bool = True) -> DataFrame:
    """The `top` owner pairs by shared neighbourhoods (at least `min_shared`), ties by owner names.

    The threshold starts at the largest set and falls until enough pairs lie above it; each step is complete above its
    threshold, so the cut is exact. A pair of sets with many owners is expanded from its first `top` + 1 names
    only, which suffice for the first `top` pairs in name order. With both_ways each pair appears in both directions
    and the cut counts directions.
    """
    sets = written(neighborhood_sets(members, top + 1))
    tokens = sets.select("set_id", F.explode("hoods").alias("neighborhood"))
    tokens = written(tokens.join(tokens.groupBy("neighborhood").agg(F.count(F.lit(1)).alias("frequency")), "neighborhood"))
    largest = sets.agg(F.max("size")).first()[0] or 0
    threshold = max(largest, min_shared)
    while True:
        found = written(set_overlaps(sets, tokens, threshold))
        by_weight = found.groupBy("weight").agg(F.sum("n_pairs").alias("n")).orderBy(F.desc("weight")).collect()
        if threshold == min_shared or sum(r["n"] for r in by_weight) >= top:
            break
        threshold = max(min_shared, min(threshold - 1, int(threshold * 0.8)))
    cut, seen = min_shared, 0
    for r in by_weight:
        cut, seen = r["weight"], seen + r["n"]
        if seen >= top:
            break
    best = found.where(C("weight") >= cut)
    expanded = (best.withColumn("x", F.explode("owners_a")).withColumn("y", F.explode("owners_b")).where(C("x") != C("y"))
                .select(F.least("x", "y").alias("owner_a"), F.greatest("x", "y").alias("owner_b"), "weight", "neighborhoods").distinct())
    pairs = expanded.orderBy(F.desc("weight"), "owner_a", "owner_b").limit(top)
    if both_ways:
        turned = pairs.select(C("owner_b").alias("owner_a"), C("owner_a").alias("owner_b"), "weight", "neighborhoods")
        pairs = pairs.unionByName(turned).orderBy(F.desc("weight"), "owner_a", "owner_b").limit(top)
    return pairs.withColumnRenamed("weight", "shared_neighborhoods")


# --- transfers ----------------------------------------------------------------
def likely_sellers(owned: DataFrame, sold: DataFrame, as_of: dt.date = settings.AS_OF, years: int = 2) -> DataFrame:
    """Properties of owners with sales in the last `years`, except those the owner has itself sold."""
    since = F.add_months(F.lit(as_of), -12 * years)
    recent = sold.where(C("sale_date") > since).groupBy(C("seller").alias("owner")).agg(F.count(F.lit(1)).alias("owner_recent_sales"))
    past = sold.select(C("seller").alias("owner"), "bbl").distinct()
    return owned.join(recent, "owner").join(past, ["owner", "bbl"], "left_anti")


def investment_flow(deeds: DataFrame, holdings: DataFrame, properties: DataFrame) -> DataFrame:
    """Flow between neighbourhoods: for each purchase with a seller on the same day, one unit from each property the
    buyer holds in another neighbourhood (from NULL if there is none) to the bought one, weighted by its value.

    Counts are multiplied, not rows: sellers are counted per property and day, purchases per buyer and destination,
    holdings per buyer and source, so a buyer meets its own neighbourhoods only once.
    """
    value = properties.select("bbl", C("assesstot").alias("value"))
    hoods = properties.select("bbl", "neighborhood")
    sellers = deeds.where(C("seller").isNotNull()).groupBy("bbl", "sale_date").agg(F.count(F.lit(1)).alias("n_sellers"))
    bought = deeds.where(C("buyer").isNotNull()).groupBy("buyer", "bbl", "sale_date").agg(F.count(F.lit(1)).alias("n_bought"))
    into = (bought.join(sellers, ["bbl", "sale_date"]).join(hoods, "bbl").join(value, "bbl", "left")
            .withColumn("n", C("n_bought") * C("n_sellers"))
            .groupBy("buyer", C("neighborhood").alias("to_neighborhood"))
            .agg(F.sum("n").alias("n"), F.sum(C("n") * F.coalesce("value", F.lit(0.0))).alias("v")))
    source = (holdings.join(hoods, "bbl").groupBy(C("owner").alias("buyer"), C("neighborhood").alias("from_neighborhood"))
              .agg(F.count(F.lit(1)).alias("held")))
    joined = into.join(source, "buyer", "left")
    other = joined.where(C("from_neighborhood") != C("to_neighborhood"))
    # purchases of buyers with nothing elsewhere keep one row from nowhere
    alone = (joined.groupBy("buyer", "to_neighborhood", "n", "v")
             .agg(F.count_if(C("from_neighborhood") != C("to_neighborhood")).alias("elsewhere")).where("elsewhere = 0")
             .select("buyer", "to_neighborhood", "n", "v", F.lit(None).cast("string").alias("from_neighborhood"), F.lit(1).cast("long").alias("held")))
    rows = other.select(alone.columns).unionByName(alone)
    return rows.groupBy("from_neighborhood", "to_neighborhood").agg(
        F.sum(C("n") * C("held")).alias("flow_count"), F.sum(C("v") * C("held")).alias("flow_value")).orderBy(
        F.desc("flow_value"), "from_neighborhood", "to_neighborhood")


# --- proximity ------------------------------------------------------------------
def nearby_locations(properties: DataFrame, km: float) -> DataFrame:
    """latitude, longitude, n_here, n_near: properties at each location, and other properties at most `km` away (those at the same spot included).

    Properties at one spot collapse to a location with a count. Locations meet in grid cells as wide as the distance; a band of latitude has its own
    width in degrees of longitude, and the columns close at the date line, so the whole globe is covered. Pairs are counted, never listed.
    """
    places = properties.where(C("latitude").isNotNull() & C("longitude").isNotNull()).groupBy("latitude", "longitude").agg(F.count(F.lit(1)).alias("n"))
    degree = settings.EARTH_RADIUS_KM * 3.141592653589793 / 180
    band = F.floor(C("latitude") * degree / km)

    def columns(r: Column) -> Column:
        """Cells around the globe in a band: as many as fit at the highest latitude that it or its neighbours reach."""
        highest = F.least(F.lit(90.0), F.greatest(F.abs(r - 1), F.abs(r + 2)) * km / degree)
        return F.greatest(F.lit(1), F.floor(360 * degree * F.cos(F.radians(highest)) * 0.999 / km))

    def cell(r: Column) -> Column:
        return F.pmod(F.floor((C("longitude") + 180) / 360 * columns(r)), columns(r))

    right = places.select(C("latitude").alias("lat_b"), C("longitude").alias("lon_b"), C("n").alias("n_b"), band.alias("r"), cell(band).alias("c"))
    around = F.array_distinct(F.flatten(F.array(*[
        F.array(*[F.struct((band + i).alias("r"), F.pmod(cell(band + i) + j, columns(band + i)).alias("c")) for j in (-1, 0, 1)]) for i in (-1, 0, 1)])))
    left = places.withColumn("s", F.explode(around)).select("latitude", "longitude", "n", C("s.r").alias("r"), C("s.c").alias("c"))
    near = left.join(right, ["r", "c"]).where(haversine_km(C("latitude"), C("longitude"), C("lat_b"), C("lon_b")) <= km)
    return near.groupBy("latitude", "longitude").agg(F.max("n").alias("n_here"), (F.sum("n_b") - 1).alias("n_near"))
