"""Fixed values and model defaults shared by the operators."""

from __future__ import annotations

import datetime as dt

# Every clock-dependent rule takes its date from the caller; this is the default.
AS_OF = dt.date(2001, 12, 31)

# --- fixed values ---------------------------------------------------------
BOROUGHS = {1: "Manhattan", 2: "Bronx", 3: "Brooklyn", 4: "Queens", 5: "Staten Island"}

LANDMARKS = {
    "grand_central": (40.7527, -73.9772),
    "penn_station": (40.7506, -73.9935),
    "world_trade_center": (40.7127, -74.0134),
    "central_park": (40.7829, -73.9654),
    "times_square": (40.7580, -73.9855),
    "hudson_yards": (40.7539, -74.0020),
}
CBD = "grand_central"
EARTH_RADIUS_KM = 6371.0

LAT_RANGE = (40.4, 41.0)
LON_RANGE = (-74.3, -73.6)
COMMERCIAL_LAND_USE = ["02", "03", "04", "05", "06", "07", "08", "09", "10", "11"]
MIN_SALE_PRICE = 100000.0
PPSF_RANGE = (50.0, 50000.0)
LOOKBACK_YEARS = 5
EXTRACT_SINCE = "2020-01-01"
PERMIT_TYPES = {
    "NB": "New Building",
    "A1": "Major Alteration",
    "A2": "Minor Alteration",
    "A3": "Minor Alteration (no plans)",
    "DM": "Demolition",
}
EXTRACT_PERMIT_TYPES = ["NB", "A1", "DM"]
SEVERE_CLASSES = ["C", "I"]

EXTRACT_CAPS = {
    "quick": {"pluto": 50000, "rolling_sales": 50000, "dob_permits": 30000, "hpd_violations": 30000},
    "professional": {"pluto": 150000, "rolling_sales": 150000, "dob_permits": 100000, "hpd_violations": 100000},
    "institutional": {"pluto": 250000, "rolling_sales": 300000, "dob_permits": 200000, "hpd_violations": 200000},
}
DEFAULT_PROFILE = "professional"

MACRO_SERIES = [
    "fed_funds_rate", "treasury_10y", "cpi_urban", "unemployment_nyc",
    "commercial_mortgage_delinquency", "cre_price_index",
]

# label, right-closed upper edge; the first class starts above the lower edge
HEIGHT_CLASSES = [("low_rise", 5), ("mid_rise", 15), ("high_rise", 30), ("tower", 60), ("supertall", 200)]
RISK_TIERS = [("Low Risk", 0.15), ("Moderate Risk", 0.35), ("Elevated Risk", 0.60), ("High Risk", 1.0)]
SELL_TIERS = [("Low", 0.2), ("Moderate", 0.4), ("Elevated", 0.6), ("High", 1.0)]

# scenario -> (drift shift, absolute drift or None, volatility factor)
SCENARIOS = {
    "Base Case": (0.0, None, 1.0),
    "Bull Case": (0.02, None, 0.8),
    "Bear Case": (-0.03, None, 1.3),
    "Stress Test (GFC-like)": (0.0, -0.08, 2.0),
    "Recovery": (0.04, None, 1.1),
}

VALUATION_FEATURES = [
    "gross_square_feet", "land_square_feet", "numfloors", "building_age", "floor_area_ratio",
    "commercial_ratio", "is_recently_renovated", "unitstotal",
    "dist_to_cbd_km", "dist_to_grand_central_km", "dist_to_hudson_yards_km",
    "dist_to_world_trade_center_km", "min_landmark_dist_km", "is_manhattan",
    "neighborhood_avg_price", "neighborhood_sales_volume", "neighborhood_permit_activity",
    "price_vs_neighborhood", "sale_year", "sale_quarter",
]
ENCODED_PREFIXES = [
    "borough_name_", "building_class_category_encoded", "height_category_", "neighborhood_target_encoded",
]
SEGMENT_FEATURES = [
    "price_per_sqft", "gross_square_feet", "building_age", "numfloors",
    "floor_area_ratio", "commercial_ratio", "dist_to_cbd_km", "assesstot",
]
SEGMENT_MARKET_FEATURES = [
    "neighborhood_avg_price", "neighborhood_sales_volume",
    "neighborhood_median_price", "neighborhood_price_std",
]
DISTRESS_FEATURES = [
    "building_age", "floor_area_ratio", "numfloors", "is_recently_renovated", "assesstot",
    "log_assesstot", "dist_to_cbd_km", "is_manhattan", "price_vs_neighborhood",
    "neighborhood_sales_volume", "neighborhood_permit_activity", "price_per_sqft",
    "violation_count", "severe_violation_count",
]
PENALTIES = [0.001, 0.01, 0.1, 1.0, 10.0, 100.0]
L1_RATIOS = [0.1, 0.3, 0.5, 0.7, 0.9]
# --- end of fixed values --------------------------------------------------

FOLDS = 5
TARGET_SMOOTHING = 10
SPARSE_THRESHOLD = 0.7
FORECAST_MONTHS = 24
SEASON = 12
HORIZON_YEARS = 5
PORTFOLIO_RHO = 0.4
