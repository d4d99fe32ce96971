"""DuckDB views for the SQL side: the same feeds as `sources.adapters`, written on their own."""

SALES = """sales AS (
  SELECT l_orderkey AS sale_id, CAST(l_partkey AS VARCHAR) AS bbl, n_regionkey + 1 AS borough,
         CAST(l_partkey // 10 AS VARCHAR) AS block, CAST(l_partkey % 10 + 1 AS VARCHAR) AS lot,
         n_name AS neighborhood, CAST(l_partkey AS VARCHAR) || ' Main Street' AS address,
         lpad(CAST(l_suppkey % 50 AS VARCHAR), 5, '0') AS zip_code, p_type AS building_class_category,
         l_returnflag AS building_class_at_sale, l_linestatus AS tax_class_at_sale,
         l_extendedprice * 20 AS sale_price, CAST(l_shipdate AS DATE) AS sale_date,
         CASE WHEN l_linenumber <> 7 THEN l_quantity * 20 END AS gross_square_feet,
         l_quantity * 30 AS land_square_feet, l_linenumber AS total_units, l_linenumber % 3 AS commercial_units,
         1900 + l_partkey % 95 AS year_built, l_tax
  FROM lineitem JOIN nation ON n_nationkey = l_partkey % 25 JOIN part ON p_partkey = l_partkey)"""

BOROUGH = """CASE {0} WHEN 1 THEN 'Manhattan' WHEN 2 THEN 'Bronx' WHEN 3 THEN 'Brooklyn'
         WHEN 4 THEN 'Queens' WHEN 5 THEN 'Staten Island' END"""

# price rule, price per square foot in range or unknown
STAGED_SALES = f"""staged AS (
  SELECT *, {BOROUGH.format('borough')} AS borough_name, year(sale_date) AS sale_year,
         month(sale_date) AS sale_month, quarter(sale_date) AS sale_quarter,
         sale_price / nullif(gross_square_feet, 0) AS price_per_sqft
  FROM sales
  WHERE sale_price >= 100000
    AND (sale_price / nullif(gross_square_feet, 0) IS NULL
         OR sale_price / nullif(gross_square_feet, 0) BETWEEN 50 AND 50000))"""

PLUTO = """pluto AS (
  SELECT CAST(p_partkey AS VARCHAR) AS bbl, n_regionkey + 1 AS borocode,
         CAST(p_partkey // 10 AS VARCHAR) AS block, CAST(p_partkey % 10 + 1 AS VARCHAR) AS lot,
         CAST(p_partkey AS VARCHAR) || ' Main Street' AS address,
         lpad(CAST(p_partkey % 50 AS VARCHAR), 5, '0') AS zipcode,
         lpad(CAST(p_partkey % 12 AS VARCHAR), 2, '0') AS landuse,
         p_brand AS bldgclass, p_type AS zonedist1, s_name AS ownername,
         CAST(p_size * 100 AS DOUBLE) AS lotarea, CAST(p_size * 100 AS DOUBLE) * (p_partkey % 7) AS bldgarea,
         CAST(p_size * 100 AS DOUBLE) * (p_partkey % 7) * CAST(0.4 AS DOUBLE) AS comarea,
         CAST(p_size * 100 AS DOUBLE) * (p_partkey % 7) * CAST(0.5 AS DOUBLE) AS resarea,
         CAST(p_size * 100 AS DOUBLE) * (p_partkey % 7) * CAST(0.25 AS DOUBLE) AS officearea,
         CAST(p_size * 100 AS DOUBLE) * (p_partkey % 7) * CAST(0.125 AS DOUBLE) AS retailarea,
         CASE WHEN p_partkey % 13 <> 0 THEN CAST(p_size * 1.5 AS DOUBLE) END AS numfloors,
         p_size * 2 AS unitstotal, p_size AS unitsres, 1900 + p_partkey % 95 AS yearbuilt,
         CASE WHEN p_partkey % 3 <> 0 THEN 1970 + p_partkey % 31 END AS yearalter1,
         p_retailprice * 1000 * (p_partkey % 11) AS assesstot, p_retailprice * 250 * (p_partkey % 11) AS assessland,
         CAST(40.4 AS DOUBLE) + (p_partkey % 650) / CAST(1000 AS DOUBLE) AS latitude,
         CAST(-74.3 AS DOUBLE) + ((7 * p_partkey) % 720) / CAST(1000 AS DOUBLE) AS longitude
  FROM part JOIN nation ON n_nationkey = p_partkey % 25
  JOIN supplier ON s_suppkey = p_partkey % (SELECT count(*) FROM supplier))"""

STAGED_PLUTO = f"""parcels AS (
  SELECT *, {BOROUGH.format('borocode')} AS borough_name FROM pluto
  WHERE latitude BETWEEN CAST(40.4 AS DOUBLE) AND CAST(41.0 AS DOUBLE)
    AND longitude BETWEEN CAST(-74.3 AS DOUBLE) AND CAST(-73.6 AS DOUBLE) AND assesstot > 0)"""

PERMITS = """permits AS (
  SELECT o_orderkey AS job_doc_number, lpad(CAST(o_custkey % 50 AS VARCHAR), 5, '0') AS zip_code,
         CASE o_orderstatus WHEN 'P' THEN 'NB' WHEN 'F' THEN 'A1' ELSE 'DM' END AS job_type,
         o_totalprice AS estimated_job_cost, o_orderdate AS filing_date, o_orderpriority AS work_type,
         o_orderstatus AS permit_status
  FROM orders)"""

VIOLATIONS = """violations AS (
  SELECT event_id AS violation_id, CAST(user_id AS VARCHAR) AS bbl,
         CASE event_type WHEN 'error' THEN 'C' WHEN 'purchase' THEN 'I' WHEN 'click' THEN 'B' ELSE 'A' END AS class,
         ts AS inspectiondate, CAST(user_id % 5 + 1 AS VARCHAR) AS boroid
  FROM events)"""

MACRO_NAMES = ["fed_funds_rate", "cre_price_index", "treasury_10y", "cpi_urban", "unemployment_nyc"]
MACRO = """observations AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'fed_funds_rate' WHEN '2-HIGH' THEN 'cre_price_index' WHEN '3-MEDIUM' THEN 'treasury_10y'
                              WHEN '4-NOT SPECIFIED' THEN 'cpi_urban' WHEN '5-LOW' THEN 'unemployment_nyc' END AS series,
         avg(o_totalprice) AS value
  FROM orders GROUP BY 1, 2)"""

DEEDS = """deeds AS (
  SELECT c_name AS buyer, s_name AS seller, CAST(l_partkey AS VARCHAR) AS bbl, n_name AS neighborhood,
         CAST(l_shipdate AS DATE) AS sale_date, l_extendedprice * 20 AS sale_price
  FROM lineitem JOIN nation ON n_nationkey = l_partkey % 25 JOIN orders ON o_orderkey = l_orderkey
  JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey)"""

HOLDINGS = """holdings AS (
  SELECT p_partkey % 100 AS portfolio_id, p_partkey AS holding_id, p_retailprice * 10000 AS value,
         CAST(0.01 AS DOUBLE) + (p_size % 5) / CAST(100 AS DOUBLE) AS drift,
         CAST(0.08 AS DOUBLE) + (p_size % 8) / CAST(100 AS DOUBLE) AS vol
  FROM part)"""


def haversine(lat: str, lon: str, lat2: float, lon2: float) -> str:
    a = (f"pow(sin(radians(CAST({lat2} AS DOUBLE) - {lat}) / 2), 2) + cos(radians({lat})) * cos(radians(CAST({lat2} AS DOUBLE)))"
         f" * pow(sin(radians(CAST({lon2} AS DOUBLE) - {lon}) / 2), 2)")
    return f"2 * CAST(6371 AS DOUBLE) * asin(sqrt({a}))"
