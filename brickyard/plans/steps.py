"""The processing steps, each callable alone: it takes tables, or reads the ones an earlier step wrote.

A step returns DataFrames (or small result dicts) and writes to a folder only when one is given.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickyard import settings
from brickyard.operators import communities, distress, distress_model, features, forecast, ownership, reports, risk, segments, series, valuation
from brickyard.plans.layers import build_layers
from brickyard.sources.extracts import extract_all
from brickyard.sources.tables import load_first, load_tables, save_metrics, save_results_json, save_tables

log = logging.getLogger(__name__)


def acquire(feeds: dict[str, DataFrame], caps: dict[str, int] | None = None, out: str | None = None) -> dict[str, DataFrame]:
    """Filtered extracts of the feeds, with the macro table passed along."""
    tables = extract_all(feeds, caps)
    if "macro_economic" in feeds:
        tables["macro_economic"] = feeds["macro_economic"]
    if out:
        save_tables(tables, out)
        tables = load_tables(feeds[next(iter(feeds))].sparkSession, out)
    return tables


def layers(spark: SparkSession, raw: dict[str, DataFrame] | None = None, raw_folder: str | None = None, out: str | None = None) -> dict[str, DataFrame]:
    """Staging, merged table and marts; the valuation mart is partitioned by borough on disk."""
    tables = build_layers(raw if raw is not None else load_tables(spark, raw_folder))
    if not out:
        return tables
    marts = {"property_valuations": ["borough_name"]} if "borough_name" in tables.get("property_valuations", spark.range(0)).columns else {}
    save_tables(tables, out, marts)
    return load_tables(spark, out)


def feature_table(
    spark: SparkSession, tables: dict[str, DataFrame] | None = None, folder: str | None = None, out: str | None = None,
    as_of: dt.date = settings.AS_OF, fold_key: str | None = None,
) -> DataFrame:
    """Engineered features from the staged sales and parcels, with permits and violations where present."""
    tables = tables if tables is not None else load_tables(spark, folder)
    if "staging_sales" not in tables:
        raise ValueError("no staged sales")
    parcels = tables.get("staging_pluto")
    if parcels is None:
        parcels = spark.createDataFrame([], "bbl string")
    out_df = features.engineer_features(parcels, tables["staging_sales"], tables.get("staging_permits"), tables.get("staging_violations"), as_of, fold_key)
    if out:
        save_tables({"featured_properties": out_df}, out)
        out_df = load_tables(spark, out)["featured_properties"]
    return out_df


def model_input(spark: SparkSession, folders: list[str]) -> DataFrame:
    """The feature table if it was written, else the valuation mart; only rows with a positive price."""
    found = load_first(spark, folders, ["featured_properties"]) or {}
    if "featured_properties" not in found:
        found = load_first(spark, folders, ["property_valuations"])
    for name in ("featured_properties", "property_valuations"):
        if name in found:
            return found[name].where(F.col("sale_price") > 0)
    raise ValueError("run the layers first")


def models(
    spark: SparkSession, table: DataFrame, macro: DataFrame | None = None, violations: DataFrame | None = None, trees: int = 500,
    restarts: int = 10, max_k: int = 12, out: str | None = None,
) -> dict[str, dict]:
    """All models on one feature table; a model that cannot be fitted is logged and left out."""
    if not valuation.enough_rows(table):
        raise ValueError("more than 100 priced rows are needed")
    results: dict[str, dict] = {}

    def attempt(name: str, run) -> None:
        try:
            results[name] = run()
        except Exception as error:
            log.warning("%s left out: %s", name, error)

    attempt("ols", lambda: valuation.fit_ols(table)[0])
    for kind in ("ridge", "lasso", "elasticnet"):
        attempt(kind, lambda kind=kind: valuation.fit_regularised(table, kind).results)
    attempt("gradient_boosting", lambda: valuation.fit_gradient_boosting(table, trees=trees).results)
    attempt("stacked_ensemble", lambda: valuation.StackedModel.fit(table, trees=min(trees, 400), forest=min(trees, 400)).results)

    def segment() -> dict:
        return segments.fit_kmeans(table, None, restarts=restarts, max_k=max_k)[2]

    def forecasts() -> dict:
        monthly = series.price_series(table, group_by="borough_name")
        columns = [c for c in settings.MACRO_SERIES if macro is not None and c in macro.columns]
        if columns:
            monthly = series.align_macro(monthly, macro, columns, ["borough_name"])
        predicted = forecast.seasonal_arma(monthly, "borough_name", "sale_price", columns)
        errors = series.forecast_errors(predicted.where("kind = 'holdout'"), "actual", "forecast")
        return errors.first().asDict()

    def risk_model() -> dict:
        labelled = distress.distress_labels(table, violations)
        return distress_model.fit_distress(labelled, trees=trees).results

    attempt("segments", segment)
    attempt("sarimax", forecasts)
    attempt("distress", risk_model)
    if out:
        board = reports.leaderboard(spark, {k: v for k, v in results.items() if k != "segments"})
        save_metrics(board, out)
        save_results_json(results, f"{out}/model_results.json")
    return results


def investment_risk(holdings: DataFrame, macro: dict | None = None) -> dict[str, DataFrame]:
    """Projection, scenarios and portfolios of a holdings table."""
    return {"projection": risk.project_values(holdings, macro=macro), "scenarios": risk.scenario_grid(holdings),
            "portfolios": risk.portfolio_risk(holdings)}


def network(table: DataFrame, as_of: dt.date = settings.AS_OF) -> dict[str, DataFrame]:
    """Ownership graph, key players, communities (of graphs with more than ten nodes) and sell signals."""
    edges, properties = ownership.ownership_edges(table), ownership.property_vertices(table)
    out = {"edges": edges, "counts": ownership.graph_counts(edges), "key_players": ownership.key_players(edges, properties),
           "sell_signals": distress.propensity_to_sell(table, as_of)}
    if out["counts"].first()["n_nodes"] > 10:
        out["communities"] = communities.ownership_communities(edges)
    return out
