"""Queries for the ownership network."""

from __future__ import annotations

from pyspark.sql import functions as F

from brickyard.operators import centrality, communities, ownership
from brickyard.operators.enrichment import merge_parcels
from brickyard.plans.oracle_views import DEEDS, PLUTO, SALES, STAGED_PLUTO, STAGED_SALES
from brickyard.plans.queries_layers import staged_parcels, staged_sales
from brickyard.plans.registry import ctes, query
from brickyard.session import written
from brickyard.sources import adapters

C = F.col
OWNED = """owned AS (SELECT upper(trim(p.ownername)) AS owner, s.bbl, s.neighborhood, p.assesstot, s.sale_price, s.sale_date
  FROM staged s JOIN parcels p USING (bbl) WHERE trim(p.ownername) <> ''),
edges AS (SELECT owner, bbl, max({'d': sale_date, 'p': sale_price}) AS latest FROM owned GROUP BY 1, 2),
props AS (SELECT bbl, any_value(neighborhood) AS neighborhood, any_value(assesstot) AS assesstot FROM owned GROUP BY 1)"""
OWNERS = (SALES, STAGED_SALES, PLUTO, STAGED_PLUTO, OWNED)


def owned_sales(spark, sf_dir):
    """Sales with their parcel's owner: the property table of the network."""
    merged = merge_parcels(staged_sales(spark, sf_dir, False), staged_parcels(spark, sf_dir))
    return merged.select("ownername", "bbl", "borough_name", "neighborhood", "assesstot", "sale_price", "sale_date")


def graph(spark, sf_dir):
    rows = owned_sales(spark, sf_dir)
    order = ["sale_date", "sale_price"]
    return ownership.ownership_edges(rows, order), ownership.property_vertices(rows, order)


def stored_graph(spark, sf_dir):
    """Edges and vertices as written tables, for queries that join them several times."""
    edges, properties = graph(spark, sf_dir)
    return written(edges, ["owner", "bbl"]), written(properties, ["bbl", "neighborhood", "assesstot"])


def stored_deeds(spark, sf_dir, *columns):
    return written(adapters.deeds(spark, sf_dir), list(columns))


@query("gr01_ownership_edges", ctes(*OWNERS) + "SELECT owner, bbl, latest.p AS sale_price, latest.d AS sale_date FROM edges", floats="sale_price")
def ownership_edges(spark, sf_dir):
    return graph(spark, sf_dir)[0]


@query("gr02_graph_counts", ctes(*OWNERS) + """
SELECT count(DISTINCT owner) AS n_owners, count(DISTINCT bbl) AS n_properties, count(*) AS n_edges,
       count(DISTINCT owner) + count(DISTINCT bbl) AS n_nodes FROM edges""")
def graph_counts(spark, sf_dir):
    return ownership.graph_counts(graph(spark, sf_dir)[0])


@query("gr04_key_players", ctes(*OWNERS, """
top AS (SELECT owner, count(*) AS n_properties, sum(assesstot) AS portfolio_value, count(DISTINCT neighborhood) AS n_neighborhoods,
         list_sort(list(DISTINCT neighborhood))[1:5] AS names FROM edges JOIN props USING (bbl) GROUP BY 1)""") + """
SELECT owner, n_properties, portfolio_value, n_neighborhoods, array_to_string(names, '|') AS neighborhoods,
       n_properties / ((SELECT count(DISTINCT owner) + count(DISTINCT bbl) FROM edges) - 1) AS degree_centrality
FROM top ORDER BY portfolio_value DESC, owner LIMIT 20""", floats="portfolio_value degree_centrality", digits={"portfolio_value": 1, "degree_centrality": 8})
def key_players(spark, sf_dir):
    """Largest portfolios with spread and degree centrality (GR4, TK1)."""
    return ownership.key_players(*stored_graph(spark, sf_dir)).withColumn("neighborhoods", F.concat_ws("|", "neighborhoods"))


# buyers of all transfers as owners: many owners with many neighbourhoods each
BUYERS = """members AS (SELECT DISTINCT upper(trim(buyer)) AS owner, neighborhood FROM deeds),
pairs AS (SELECT a.owner AS owner_a, b.owner AS owner_b, count(*) AS weight, list_sort(list(a.neighborhood)) AS shared
          FROM members a JOIN members b ON a.neighborhood = b.neighborhood AND a.owner <> b.owner GROUP BY 1, 2)"""


@query("gr05_betweenness", ctes(DEEDS, BUYERS, """
sets AS (SELECT owner, list_sort(list(neighborhood)) AS hoods FROM members GROUP BY 1),
nodes AS (SELECT row_number() OVER (ORDER BY hoods) AS node, hoods, count(*) AS owners FROM sets GROUP BY hoods),
near AS (SELECT a.node AS a, b.node AS b, b.owners FROM nodes a JOIN nodes b ON a.node <> b.node AND list_has_any(a.hoods, b.hoods)),
far AS (SELECT a.node AS s, b.node AS v, b.owners FROM nodes a JOIN nodes b ON a.node <> b.node AND NOT list_has_any(a.hoods, b.hoods)),
second AS (SELECT far.s, far.v, any_value(far.owners) AS owners, sum(one.owners) AS paths
           FROM far JOIN near AS one ON one.a = far.s JOIN near AS two ON two.a = one.b AND two.b = far.v GROUP BY 1, 2),
lost AS (SELECT count(*) AS n FROM (SELECT s, v FROM far EXCEPT SELECT s, v FROM second)),
shares AS (SELECT one.b AS node, sum(st.owners * second.owners / paths) AS share
           FROM second JOIN nodes st ON st.node = second.s JOIN near AS one ON one.a = second.s JOIN near AS two ON two.a = one.b AND two.b = second.v GROUP BY 1),
size AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM sets)""") + """
SELECT owner, coalesce(share, 0) / ((size.n - 1) * (size.n - 2)) AS betweenness FROM sets JOIN nodes USING (hoods) LEFT JOIN shares USING (node), size, lost
WHERE lost.n = 0""", floats="betweenness", digits=9)
def betweenness(spark, sf_dir):
    """Betweenness of all buyers in the projection (GR5). The SQL twin counts paths over one owner between, which are all there are when no two buyers are farther apart; else it has no rows."""
    deeds = stored_deeds(spark, sf_dir, "buyer", "neighborhood")
    members = deeds.select(F.upper(F.trim("buyer")).alias("owner"), "neighborhood").distinct()
    return centrality.betweenness(members)


@query("gr08_largest_portfolios", ctes(*OWNERS) + """
SELECT owner, count(*) AS n_properties, sum(assesstot) AS portfolio_value FROM edges JOIN props USING (bbl) GROUP BY 1
ORDER BY 3 DESC, 1 LIMIT 20""", floats="portfolio_value", digits=1)
def largest_portfolios(spark, sf_dir):
    return ownership.largest_portfolios(*graph(spark, sf_dir))



def buyer_memberships(spark, sf_dir):
    deeds = stored_deeds(spark, sf_dir, "buyer", "bbl", "neighborhood")
    edges = ownership.ownership_edges(deeds.select(C("buyer").alias("owner"), "bbl"))
    return written(ownership.memberships(edges, deeds.groupBy("bbl").agg(F.min("neighborhood").alias("neighborhood"))))


@query("gr03_projection_degrees", ctes(DEEDS, BUYERS) + """
SELECT m.owner, count(*) AS n_neighborhoods, (SELECT CAST(sum(weight) AS BIGINT) FROM pairs p WHERE p.owner_a = m.owner) AS weighted_degree
FROM members m GROUP BY m.owner""")
def projection_degrees(spark, sf_dir):
    """Weighted degree of every owner in the owner-owner projection; the SQL twin lists all pairs (GR3, JN9)."""
    return ownership.projection_degrees(buyer_memberships(spark, sf_dir))


@query("gr03_owner_links", ctes(DEEDS, BUYERS, """
top AS (SELECT owner FROM members GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 20)""") + """
SELECT owner_a, owner_b, weight, array_to_string(shared, '|') AS shared_neighborhoods FROM pairs WHERE owner_a IN (SELECT owner FROM top)""")
def owner_links(spark, sf_dir):
    """Weighted projection edges of the twenty most spread owners (GR3, JN9)."""
    members = buyer_memberships(spark, sf_dir)
    top = members.groupBy("owner").count().orderBy(F.desc("count"), "owner").limit(20)
    return ownership.owner_links(members, top).withColumn("shared_neighborhoods", F.concat_ws("|", "shared_neighborhoods"))


@query("gr09_co_investment", ctes(DEEDS, BUYERS) + """
SELECT owner_a, owner_b, weight AS shared_neighborhoods, array_to_string(shared, '|') AS neighborhoods FROM pairs WHERE weight >= 3
ORDER BY weight DESC, owner_a, owner_b LIMIT 50""")
def co_investment(spark, sf_dir):
    """Fifty owner pairs with most shared neighbourhoods (GR9, JN10)."""
    return ownership.co_investment(buyer_memberships(spark, sf_dir)).withColumn("neighborhoods", F.concat_ws("|", "neighborhoods"))


@query("gr10_likely_sellers", ctes(DEEDS, PLUTO, """
recent AS (SELECT seller, count(*) AS n FROM deeds WHERE sale_date > DATE '1999-12-31' GROUP BY 1)""") + """
SELECT p.ownername AS owner, p.bbl, p.assesstot, r.n AS owner_recent_sales FROM pluto p JOIN recent r ON r.seller = p.ownername
WHERE NOT EXISTS (SELECT 1 FROM deeds d WHERE d.seller = p.ownername AND d.bbl = p.bbl)""", floats="assesstot")
def likely_sellers(spark, sf_dir):
    """Parcels of recent sellers which they have not sold (GR10, JN8)."""
    owned = adapters.pluto(spark, sf_dir).select(C("ownername").alias("owner"), "bbl", "assesstot")
    return ownership.likely_sellers(owned, stored_deeds(spark, sf_dir, "seller", "bbl", "sale_date"))


@query("gr11_investment_flow", ctes(DEEDS, PLUTO, """
held AS (SELECT DISTINCT buyer, bbl, neighborhood FROM deeds),
trades AS (SELECT b.buyer, b.bbl, b.neighborhood, p.assesstot FROM deeds b JOIN deeds s ON s.bbl = b.bbl AND s.sale_date = b.sale_date
           JOIN pluto p ON p.bbl = b.bbl)""") + """
SELECT h.neighborhood AS from_neighborhood, t.neighborhood AS to_neighborhood, count(*) AS flow_count, sum(t.assesstot) AS flow_value
FROM trades t LEFT JOIN held h ON h.buyer = t.buyer AND h.neighborhood <> t.neighborhood GROUP BY 1, 2""", floats="flow_value", digits=0)
def investment_flow(spark, sf_dir):
    """Capital flow between neighbourhoods; the SQL twin joins every holding with every purchase (GR11, JN11)."""
    deeds = stored_deeds(spark, sf_dir, "buyer", "seller", "bbl", "neighborhood", "sale_date")
    hoods = deeds.groupBy("bbl").agg(F.min("neighborhood").alias("neighborhood"))
    properties = hoods.join(adapters.pluto(spark, sf_dir).select("bbl", "assesstot"), "bbl")
    held = deeds.select(C("buyer").alias("owner"), "bbl").distinct()
    return ownership.investment_flow(deeds, held, properties)


@query("gr06_ownership_communities", ctes(*OWNERS) + """
SELECT 'all' AS part, count(DISTINCT owner) AS n_communities, count(DISTINCT owner) AS n_owners, count(DISTINCT bbl) AS n_properties FROM edges""")
def ownership_communities(spark, sf_dir):
    """Communities of the ownership graph; each parcel has one owner here, so every portfolio is one community (GR6)."""
    found = communities.ownership_communities(graph(spark, sf_dir)[0])
    return found.agg(F.count(F.lit(1)).alias("n_communities"), F.sum("n_owners").alias("n_owners"), F.sum("n_properties").alias("n_properties")) \
        .select(F.lit("all").alias("part"), "n_communities", "n_owners", "n_properties")


@query("gr06_modularity", ctes(DEEDS, """
e AS (SELECT DISTINCT buyer, bbl, neighborhood FROM deeds),
home AS (SELECT buyer, min(neighborhood) AS c FROM e GROUP BY 1),
ends AS (SELECT c FROM e JOIN home USING (buyer) UNION ALL SELECT neighborhood FROM e),
d AS (SELECT c, count(*) AS d FROM ends GROUP BY 1)""") + """
SELECT (SELECT count(*) FROM e JOIN home USING (buyer) WHERE c = neighborhood) / (SELECT count(*) FROM e)
       - (SELECT sum(d * d) FROM d) / (4 * pow((SELECT count(*) FROM e), 2)) AS modularity""", floats="modularity", digits=8)
def modularity(spark, sf_dir):
    """Modularity of a labelling: properties by neighbourhood, buyers by the first of theirs (GR6)."""
    edges = adapters.deeds(spark, sf_dir).select("buyer", "bbl", "neighborhood").distinct()
    home = edges.groupBy(C("buyer").alias("id")).agg(F.min("neighborhood").alias("community"))
    place = edges.select(F.concat(F.lit("p"), "bbl").alias("id"), C("neighborhood").alias("community")).distinct()
    pairs = edges.select(C("buyer").alias("src"), F.concat(F.lit("p"), "bbl").alias("dst"), F.lit(1.0).alias("weight"))
    return communities.modularity(pairs, home.unionByName(place))


@query("gr07_components", ctes(*OWNERS) + """
SELECT 'owner:' || owner AS id, 'owner:' || owner AS component FROM (SELECT DISTINCT owner FROM edges)
UNION ALL SELECT 'property:' || bbl, 'owner:' || owner FROM edges""")
def components(spark, sf_dir):
    """Connected components of the ownership graph, named by their smallest node (GR7)."""
    edges = graph(spark, sf_dir)[0]
    return communities.connected_components(edges.select(
        F.concat(F.lit("owner:"), "owner").alias("src"), F.concat(F.lit("property:"), "bbl").alias("dst")))


@query("gr12_nearby_locations", ctes(PLUTO, """
places AS (SELECT latitude AS lat, longitude AS lon, count(*) AS n FROM pluto GROUP BY 1, 2)""") + """
SELECT a.lat AS latitude, a.lon AS longitude, a.n AS n_here, CAST(sum(b.n) - 1 AS BIGINT) AS n_near FROM places a JOIN places b
  ON 2 * 6371 * asin(sqrt(pow(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * pow(sin(radians(b.lon - a.lon) / 2), 2))) <= 1.5
GROUP BY ALL""", floats="latitude longitude")
def nearby_locations(spark, sf_dir):
    """Parcel locations within 1.5 km of each other (GR12)."""
    return ownership.nearby_locations(adapters.pluto(spark, sf_dir), 1.5)
