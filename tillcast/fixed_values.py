"""Thresholds, labels, lists and formats that results depend on."""

# --- weather ---------------------------------------------------------------
EXTREME_HEAT_ABOVE = 35
HEAVY_RAIN_ABOVE = 10
ANOMALY_STDDEVS = 2
SEASON_MONTHS = {
    "Winter": [12, 1, 2],
    "Spring": [3, 4, 5],
    "Summer": [6, 7, 8],
    "Fall": [9, 10, 11],
}
SEASONS = list(SEASON_MONTHS)
UNKNOWN_LABEL = "Unknown"
WEATHER_LABELS = {
    0: "Clear Sky",
    1: "Mainly Clear",
    2: "Partly Cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Icy Fog",
    51: "Light Drizzle",
    53: "Moderate Drizzle",
    55: "Dense Drizzle",
    61: "Slight Rain",
    63: "Moderate Rain",
    65: "Heavy Rain",
    71: "Slight Snow",
    73: "Moderate Snow",
    75: "Heavy Snow",
    80: "Slight Showers",
    81: "Moderate Showers",
    82: "Violent Showers",
    95: "Thunderstorm",
}

# --- weather shocks --------------------------------------------------------
UNSEASONABLE_HEAT_ABOVE = 8
WET_ABOVE = 2
WET_POINTS = 2
COLD_BELOW = 15
DETERRING_CODES = [2, 3, 45, 48, 51, 53, 55, 61, 63, 65]

# --- calendar --------------------------------------------------------------
DAY_NAMES = {
    1: "Saturday",
    2: "Sunday",
    3: "Monday",
    4: "Tuesday",
    5: "Wednesday",
    6: "Thursday",
    7: "Friday",
}

# --- CSV cells that mean "no value" ----------------------------------------
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- forecasting -----------------------------------------------------------
TRAIN_TEST_CUTOFF = "2016-01-01"
BASE_FEATURES = [
    "sales_lag_7", "sales_lag_14", "sales_rolling_avg_7d", "sales_rolling_avg_14d",
    "day_of_week", "snap_ca", "is_event",
]
WEATHER_FEATURES = BASE_FEATURES + [
    "temperature_max", "precipitation_sum", "is_extreme_heat", "is_heavy_rain",
    "temp_anomaly_from_monthly", "temp_change_3d", "shopping_deterrence", "unseasonable_heat",
    "tomorrow_temp", "tomorrow_precipitation", "tomorrow_extreme_heat", "tomorrow_heavy_rain",
]
WEATHER_REGRESSORS = [
    "temperature_max", "precipitation_sum", "temp_anomaly_from_monthly", "shopping_deterrence",
    "unseasonable_heat", "tomorrow_temp", "tomorrow_precipitation",
]
BOOSTED_TREES = 500
BOOSTED_LEARNING_RATE = 0.05
BOOSTED_DEPTH = 6
BOOSTED_SUBSAMPLE = 0.8
BOOSTED_SEED = 42
RESIDUAL_BINS = 25

# Column of the forecast table -> title in reports.
MODEL_TITLES = {
    "naive_prediction": "Naive Baseline",
    "prophet_no_weather": "Prophet (no weather)",
    "prophet_with_weather": "Prophet (with weather)",
    "xgb_no_weather": "XGBoost (no weather)",
    "xgb_with_weather": "XGBoost (with weather)",
}

# --- importance chart groups: first rule with a matching part of the name wins ---
FEATURE_GROUPS = [
    ("weather", ["tomorrow", "weather", "temp_anomaly", "shopping", "unseasonable"]),
    ("sales_calendar", ["sales", "snap", "event"]),
]
OTHER_FEATURE_GROUP = "other"

# --- recommendations -------------------------------------------------------
GENERATION_ATTEMPTS = 3
GENERATION_PAUSE_SECONDS = 10.0
UNAVAILABLE_TEXT = "[Recommendation unavailable: {error}]"
SNAP_DAYS_SHOWN = 5
PROMPT_TEMPLATE = """You are a supply chain intelligence system for the %s %s 
department in %s.

Generate an operational inventory recommendation based on this data:

DATE: %s (%s)

FORECAST:
- Forecasted demand: %s units
- Actual demand: %s units
- Demand vs 7-day average: %s%%

WEATHER:
- Temperature: %s°C
- Precipitation: %smm
- Conditions: %s
- Season: %s
- Weather anomaly: %s
- Extreme heat: %s
- Heavy rain: %s

CALENDAR:
- SNAP benefits active: %s
- Special event: %s

Generate recommendation in exactly this format:

DEMAND OUTLOOK: [1 sentence]

PRIMARY DRIVERS:
- [driver 1]
- [driver 2]
- [driver 3]

WEATHER IMPACT: [1 sentence on weather effect]

INVENTORY ACTION: [specific actionable recommendation]

RISK LEVEL: [LOW / MODERATE / ELEVATED / HIGH] — [1 sentence reason]

Keep under 150 words. Be specific and operational."""
