"""Layer composition: raw feeds -> staging -> merged features -> marts, all lazy."""

from __future__ import annotations

from pyspark.sql import DataFrame

from brickyard.operators import enrichment, marts, staging

STAGERS = {
    "pluto": ("pluto", staging.stage_parcels),
    "rolling_sales": ("sales", staging.stage_sales),
    "dob_permits": ("permits", staging.stage_permits),
    "hpd_violations": ("violations", staging.stage_violations),
}


def build_layers(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Stage every feed that is present, merge, and derive the two marts.

    Without parcels the marts come from sales alone; without sales there are no marts.
    """
    out = {f"staging_{name}": stage(raw[feed]) for feed, (name, stage) in STAGERS.items() if feed in raw}
    sales, parcels = out.get("staging_sales"), out.get("staging_pluto")
    if sales is not None:
        features = enrichment.merge_parcels(sales, parcels) if parcels is not None else sales
        out["int_property_features"] = features
        out["property_valuations"] = marts.property_valuations(features)
        segments = marts.market_segments(features)
        if segments is not None:
            out["market_segments"] = segments
    if "macro_economic" in raw:
        out["macro_economic"] = raw["macro_economic"]
    return out
