"""The driver's star-schema tables seen as the five property feeds (FIXTURES.md section 3).

`*_feed` functions give text columns the way a raw feed does; the others give typed columns. Sales come from
`lineitem`, parcels from `part`, permits from `orders`, violations from `events`. Nothing is filtered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from brickyard.sources.tables import table

C = F.col


def _hoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        C("n_nationkey").cast("long").alias("hood_key"), C("n_name").alias("neighborhood"),
        (C("n_regionkey") + 1).cast("int").alias("borough"))


def _money_text(value: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(value, 2))


def sales(spark: SparkSession, sf_dir: str, with_class: bool = True) -> DataFrame:
    """Typed sales. Without the building class the part table is not read at all."""
    lines = table(spark, sf_dir, "lineitem").withColumn("hood_key", C("l_partkey") % 25)
    out = lines.join(_hoods(spark, sf_dir), "hood_key")
    if with_class:
        part = table(spark, sf_dir, "part").select(
            C("p_partkey").alias("l_partkey"), C("p_type").alias("building_class_category"))
        out = out.join(part, "l_partkey")
    return out.select(
        C("l_orderkey").alias("sale_id"),
        C("l_partkey").cast("string").alias("bbl"),
        "borough",
        F.floor(C("l_partkey") / 10).cast("string").alias("block"),
        (C("l_partkey") % 10 + 1).cast("string").alias("lot"),
        "neighborhood",
        F.concat_ws(" ", C("l_partkey").cast("string"), F.lit("Main Street")).alias("address"),
        F.lpad((C("l_suppkey") % 50).cast("string"), 5, "0").alias("zip_code"),
        *([C("building_class_category")] if with_class else []),
        C("l_returnflag").alias("building_class_at_time_of_sale"),
        C("l_linestatus").alias("tax_class_at_time_of_sale"),
        (C("l_extendedprice") * 20).alias("sale_price"),
        C("l_shipdate").cast("date").alias("sale_date"),
        F.when(C("l_linenumber") != 7, C("l_quantity") * 20).alias("gross_square_feet"),
        (C("l_quantity") * 30).alias("land_square_feet"),
        C("l_linenumber").alias("total_units"),
        (C("l_linenumber") % 3).alias("commercial_units"),
        (1900 + C("l_partkey") % 95).cast("int").alias("year_built"),
    )


def sales_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text sales: padded names, '$1,234.50' prices, MM/dd/yyyy dates, 'N/A' where tax is 8 percent."""
    lines = table(spark, sf_dir, "lineitem").withColumn("hood_key", C("l_partkey") % 25)
    part = table(spark, sf_dir, "part").select(C("p_partkey").alias("l_partkey"), "p_type")
    return lines.join(_hoods(spark, sf_dir), "hood_key").join(part, "l_partkey").select(
        C("l_orderkey").alias("SALE_ID"),
        C("borough").cast("string").alias("BOROUGH"),
        F.floor(C("l_partkey") / 10).cast("string").alias("BLOCK"),
        (C("l_partkey") % 10 + 1).cast("string").alias("LOT"),
        C("l_partkey").cast("string").alias("bbl"),
        F.concat(F.lit("  "), "neighborhood", F.lit(" ")).alias("NEIGHBORHOOD"),
        F.concat_ws(" ", C("l_partkey").cast("string"), F.lit("Main Street ")).alias("address"),
        F.concat(F.lpad((C("l_suppkey") % 50).cast("string"), 5, "0"), F.lit(" ")).alias("zip_code"),
        C("l_returnflag").alias("building_class_at_time_of_sale"),
        C("l_returnflag").alias("building_class_at_present"),
        F.concat(F.lit(" "), "p_type").alias("building_class_category"),
        C("l_linestatus").alias("tax_class_at_time_of_sale"),
        F.when(C("l_tax") == 0.08, F.lit("N/A")).otherwise(_money_text(C("l_extendedprice") * 20)).alias("sale_price"),
        F.date_format("l_shipdate", "MM/dd/yyyy").alias("sale_date"),
        F.when(C("l_linenumber") == 7, F.lit("")).otherwise(F.format_number(C("l_quantity") * 20, 0)).alias("gross_square_feet"),
        F.format_number(C("l_quantity") * 30, 0).alias("land_square_feet"),
        (C("l_linenumber") - C("l_linenumber") % 3).cast("string").alias("residential_units"),
        (C("l_linenumber") % 3).cast("string").alias("commercial_units"),
        C("l_linenumber").cast("string").alias("total_units"),
        (1900 + C("l_partkey") % 95).cast("string").alias("year_built"),
    )


def pluto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed parcels, one per part. The owner is the supplier with key p_partkey modulo the supplier count."""
    suppliers = table(spark, sf_dir, "supplier")
    n_suppliers = suppliers.agg(F.count(F.lit(1))).scalar()
    owners = suppliers.select(C("s_suppkey").alias("owner_key"), C("s_name").alias("ownername"))
    part = table(spark, sf_dir, "part").select(
        "p_partkey", "p_size", "p_retailprice", "p_brand", "p_type",
        (C("p_partkey") % 25).alias("hood_key"), (C("p_partkey") % n_suppliers).alias("owner_key"))
    key, size = C("p_partkey"), C("p_size")
    lot_area = (size * 100).cast("double")
    bldg_area = lot_area * (key % 7)
    return part.join(_hoods(spark, sf_dir), "hood_key").join(owners, "owner_key").select(
        key.cast("string").alias("bbl"),
        C("borough").alias("borocode"),
        F.floor(key / 10).cast("string").alias("block"),
        (key % 10 + 1).cast("string").alias("lot"),
        F.concat_ws(" ", key.cast("string"), F.lit("Main Street")).alias("address"),
        F.lpad((key % 50).cast("string"), 5, "0").alias("zipcode"),
        F.lpad((key % 12).cast("string"), 2, "0").alias("landuse"),
        C("p_brand").alias("bldgclass"), C("p_type").alias("zonedist1"),
        F.lit(None).cast("string").alias("overlay1"),
        "ownername",
        lot_area.alias("lotarea"), bldg_area.alias("bldgarea"),
        (bldg_area * 0.4).alias("comarea"), (bldg_area * 0.5).alias("resarea"),
        (bldg_area * 0.25).alias("officearea"), (bldg_area * 0.125).alias("retailarea"),
        F.when(key % 13 != 0, size * 1.5).alias("numfloors"),
        (size * 2).cast("int").alias("unitstotal"), size.cast("int").alias("unitsres"),
        (1900 + key % 95).cast("int").alias("yearbuilt"),
        F.when(key % 3 != 0, 1970 + key % 31).cast("int").alias("yearalter1"),
        F.lit(None).cast("int").alias("yearalter2"),
        (C("p_retailprice") * 1000 * (key % 11)).alias("assesstot"),
        (C("p_retailprice") * 250 * (key % 11)).alias("assessland"),
        (40.4 + (key % 650) / 1000.0).alias("latitude"),
        (-74.3 + ((7 * key) % 720) / 1000.0).alias("longitude"),
    )


def pluto_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcels as a raw feed: every parcel twice (an older, lower assessment), upper-case padded column names."""
    base = pluto(spark, sf_dir)
    older = F.array(F.lit(1.0), F.lit(0.5))
    doubled = base.withColumn("age", F.explode(older)).withColumn("assesstot", C("assesstot") * C("age")).drop("age")
    return doubled.withColumn("landuse", F.concat(F.lit(" "), "landuse")).withColumnsRenamed(
        {"landuse": " LandUse", "borocode": "BoroCode "})


def permits(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = F.when(C("o_orderstatus") == "P", "NB").when(C("o_orderstatus") == "F", "A1").otherwise("DM")
    return table(spark, sf_dir, "orders").select(
        C("o_orderkey").alias("job_doc_number"),
        F.lpad((C("o_custkey") % 50).cast("string"), 5, "0").alias("zip_code"),
        kinds.alias("job_type"),
        C("o_orderpriority").alias("work_type"), C("o_orderstatus").alias("permit_status"),
        C("o_totalprice").alias("estimated_job_cost"),
        C("o_orderdate").alias("filing_date"),
    )


def permits_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Permits as text: ISO stamps with fractions ('' for high priority), costs with commas, padded codes."""
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS")
    return table(spark, sf_dir, "orders").select(
        C("o_orderkey").alias("job_doc_number"),
        F.concat(F.lpad((C("o_custkey") % 50).cast("string"), 5, "0"), F.lit("  ")).alias("zip_code"),
        F.concat(F.lit(" "), F.when(C("o_orderstatus") == "P", "NB").when(C("o_orderstatus") == "F", "A1")
                 .otherwise("ZZ")).alias("job_type"),
        C("o_orderpriority").alias("work_type"), C("o_orderstatus").alias("permit_status"),
        F.format_number("o_totalprice", 2).alias("estimated_job_cost"),
        F.when(C("o_orderpriority") == "2-HIGH", F.lit("")).otherwise(stamp).alias("filing_date"),
        stamp.alias("issuance_date"),
    )


def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = (F.when(C("event_type") == "error", "C").when(C("event_type") == "purchase", "I")
            .when(C("event_type") == "click", "B").otherwise("A"))
    return table(spark, sf_dir, "events").select(
        C("event_id").alias("violation_id"),
        C("user_id").cast("string").alias("bbl"),
        kind.alias("class"),
        C("ts").alias("inspectiondate"),
        (C("user_id") % 5 + 1).cast("string").alias("boroid"),
    )


#: The macro series that the order priorities stand for.
MACRO = {"1-URGENT": "fed_funds_rate", "2-HIGH": "cre_price_index", "3-MEDIUM": "treasury_10y", "4-NOT SPECIFIED": "cpi_urban", "5-LOW": "unemployment_nyc"}


def macro_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long (date, series, value): daily mean order value of each priority."""
    series = F.create_map(*[F.lit(x) for pair in MACRO.items() for x in pair])[C("o_orderpriority")]
    return table(spark, sf_dir, "orders").groupBy(C("o_orderdate").cast("date").alias("date"), series.alias("series")).agg(
        F.avg("o_totalprice").alias("value"))


def deeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers: buyer = ordering customer, seller = supplier, property = part, dated by shipment."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice", (C("l_partkey") % 25).alias("hood_key"))
    orders = table(spark, sf_dir, "orders").select(C("o_orderkey").alias("l_orderkey"), C("o_custkey").alias("c_custkey"))
    buyers = table(spark, sf_dir, "customer").select("c_custkey", C("c_name").alias("buyer"))
    sellers = table(spark, sf_dir, "supplier").select(C("s_suppkey").alias("l_suppkey"), C("s_name").alias("seller"))
    return (lines.join(_hoods(spark, sf_dir), "hood_key").join(orders, "l_orderkey").join(buyers, "c_custkey")
            .join(sellers, "l_suppkey")
            .select("buyer", "seller", C("l_partkey").cast("string").alias("bbl"), "neighborhood",
                    C("l_shipdate").cast("date").alias("sale_date"),
                    (C("l_extendedprice") * 20).alias("sale_price")))


def holdings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Investment holdings with drift and volatility; portfolios of one hundredth of the parts each."""
    key, size = C("p_partkey"), C("p_size")
    return table(spark, sf_dir, "part").select(
        (key % 100).cast("long").alias("portfolio_id"), key.alias("holding_id"),
        (C("p_retailprice") * 10000).alias("value"),
        (0.01 + (size % 5) / 100.0).alias("drift"), (0.08 + (size % 8) / 100.0).alias("vol"))


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents with a score in [0, 1), for classifier metrics."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return table(spark, sf_dir, "labels").join(docs, "doc_id").select(
        "doc_id", C("toxic").cast("int").alias("y"), ((C("n_chars") % 1000) / 1000.0).alias("score"))


def labelled_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("vector"),
                          C("label").alias("cluster"))
