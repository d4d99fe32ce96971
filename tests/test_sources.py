import json

from pyspark.sql import functions as F

from brickyard.plans import steps
from brickyard.sources import adapters, extracts, tables


def test_round_trip_and_fallback(spark, tmp_path):
    df = spark.createDataFrame([(1, "Bronx"), (2, "Queens"), (3, None)], "id int, borough_name string")
    raw, processed = str(tmp_path / "raw"), str(tmp_path / "processed")
    tables.save_tables({"pluto": df, "property_valuations": df}, raw, {"property_valuations": ["borough_name"]})
    back = tables.load_tables(spark, raw, views=True)
    assert set(back) == {"pluto", "property_valuations"} and spark.sql("select count(*) from pluto").first()[0] == 3
    assert (tmp_path / "raw" / "property_valuations.parquet" / "borough_name=Bronx").exists()
    assert back["property_valuations"].where("borough_name = 'Queens'").count() == 1
    assert set(tables.load_first(spark, [processed, raw], ["pluto"])) == {"pluto"}
    assert set(tables.load_first(spark, [processed, raw], ["absent"])) == {"pluto", "property_valuations"}
    out = tables.materialise({"stg": df, "mart": df}, {"stg": "view", "mart": "table"}, processed)
    assert out["mart"].inputFiles() and spark.table("stg").count() == 3


def test_caps():
    assert extracts.resolve_caps("quick")["pluto"] == 50000
    assert extracts.resolve_caps("nope", pluto=7, rolling_sales=0, dob_permits=-1, hpd_violations=None) == {
        "pluto": 7, "rolling_sales": 150000, "dob_permits": 100000, "hpd_violations": 100000}


def test_csv_edges(spark, tmp_path):
    from brickyard.operators.ownership import edges_from_csv

    path = tmp_path / "p.csv"
    path.write_text("ownername,bbl,assesstot\n acme ,1,5\nACME,1,6\n,2,1\n")
    assert [tuple(r) for r in edges_from_csv(spark, str(path)).collect()] == [("ACME", "1")]


def test_filters_reach_the_scan(spark, sf):
    plan = extracts.extract(tables.table(spark, sf, "orders"), "o_orderstatus = 'F'", ["o_orderkey"])._jdf.queryExecution().toString()
    assert "EqualTo(o_orderstatus,F)" in plan and "o_totalprice" not in plan.split("ReadSchema")[1]


def test_steps_chain_from_files(spark, sf, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    feeds = {"pluto": adapters.pluto(spark, sf), "rolling_sales": adapters.sales(spark, sf), "dob_permits": adapters.permits(spark, sf), "hpd_violations": adapters.violations(spark, sf)}
    got = steps.acquire({**feeds, "dob_permits": feeds["dob_permits"].withColumn("filing_date", F.col("filing_date") + F.expr("interval 30 years"))}, {"pluto": 100}, raw)
    assert got["pluto"].count() == 100
    marts = steps.layers(spark, raw_folder=raw, out=out)
    assert {"staging_pluto", "staging_sales", "property_valuations", "market_segments"} <= set(marts)
    table = steps.feature_table(spark, folder=out, out=out, fold_key="sale_id")
    assert table.where("sale_price is null").count() == 0
    same = steps.model_input(spark, [out])
    assert same.count() == table.count()
    linked = steps.network(same)
    assert {"edges", "counts", "key_players", "sell_signals"} <= set(linked)
    results = steps.models(spark, same, trees=2, restarts=1, max_k=3, out=str(tmp_path / "report"))
    assert {"ols", "ridge", "lasso", "elasticnet", "gradient_boosting", "stacked_ensemble", "segments", "sarimax"} <= set(results), results.keys()
    assert json.loads((tmp_path / "report" / "model_results.json").read_text())["ridge"]["n_train"] > 0
    assert spark.read.option("header", True).csv(str(tmp_path / "report" / "model_metrics")).count() >= 7
    risk = steps.investment_risk(adapters.holdings(spark, sf))
    assert risk["scenarios"].count() == 5 * 200


def test_json_cut(spark, tmp_path):
    tables.save_results_json({"t": spark.range(300).toDF("i"), "n": {1: (1, None)}}, str(tmp_path / "r.json"))
    got = json.loads((tmp_path / "r.json").read_text())
    assert len(got["t"]) == 200 and got["n"] == {"1": [1, None]}
