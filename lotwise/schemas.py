"""Schemas of the landed inputs and the fixed vocabularies of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

LOT = "parking_lot_id"

OPERATIONS = T.StructType([
    T.StructField("parking_lot_id", T.IntegerType(), False),
    T.StructField("parking_space_id", T.IntegerType(), False),
    T.StructField("arrival_unix_seconds", T.LongType(), False),
    T.StructField("departure_unix_seconds", T.LongType(), False),
    T.StructField("xml_id", T.IntegerType(), False),
])

WEATHER_DOCUMENT = T.StructType([
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("hourly", T.StructType([
        T.StructField("time", T.ArrayType(T.StringType())),
        T.StructField("temperature_2m", T.ArrayType(T.DoubleType())),
        T.StructField("relative_humidity_2m", T.ArrayType(T.DoubleType())),
        T.StructField("precipitation", T.ArrayType(T.DoubleType())),
        T.StructField("wind_speed_10m", T.ArrayType(T.DoubleType())),
        T.StructField("weather_code", T.ArrayType(T.IntegerType())),
    ])),
])

LANDED_SNAPSHOT = T.StructType([
    T.StructField("fetched_at", T.TimestampType(), False),
    T.StructField("sequence", T.LongType(), False),
    T.StructField("payload", T.StringType()),
])

HOURLY = T.StructType([
    T.StructField("parking_lot_id", T.IntegerType(), False),
    T.StructField("hour_timestamp", T.TimestampType(), False),
    T.StructField("avg_free_spaces", T.DoubleType()),
    T.StructField("min_free_spaces", T.LongType()),
    T.StructField("max_free_spaces", T.LongType()),
    T.StructField("free_spaces_range", T.LongType()),
])

# Column types of the stored tables; computation runs in double or exact integers and
# is narrowed to these only when a table is written.
STORED_TYPES = {
    "avg_free_spaces": "decimal(10,2)",
    "avg_free_spaces_rolling_24h": "decimal(10,2)",
    "avg_free_spaces_std_24h": "decimal(10,2)",
    "avg_free_spaces_diff_1h": "decimal(10,2)",
    "temperature_diff_1h": "decimal(5,2)",
    "temperature_2m": "decimal(5,2)",
    "relative_humidity_2m": "decimal(5,2)",
    "precipitation": "decimal(7,2)",
    "wind_speed_10m": "decimal(6,2)",
    "occupancy_rate": "decimal(5,2)",
    "latitude": "decimal(10,7)",
    "longitude": "decimal(10,7)",
    "confidence_score": "decimal(5,4)",
    "prediction_error": "decimal(10,2)",
    "absolute_error": "decimal(10,2)",
    "percentage_error": "decimal(6,2)",
}

# ---------------------------------------------------------------------------------------
# Fixed values. Category rules as (label, condition on the column); first match wins.

WEEKEND_DAYS = (0, 6)

TRAINING_CATEGORIES = {
    "day_type": ("day_of_week", [("Weekend", "in (0, 6)")], "Weekday"),
    "time_period": ("hour_of_day", [
        ("Morning Rush", "between 6 and 9"),
        ("Daytime", "between 10 and 16"),
        ("Evening Rush", "between 17 and 19"),
        ("Evening", "between 20 and 23"),
    ], "Night"),
    "temperature_category": ("temperature_2m", [
        ("Freezing", "< 0"),
        ("Cold", "between 0 and 10"),
        ("Mild", "between 11 and 20"),
        ("Warm", "between 21 and 30"),
    ], "Hot"),
    "precipitation_category": ("precipitation", [
        ("No Rain", "= 0"),
        ("Light Rain", "<= 2.5"),
        ("Moderate Rain", "<= 10"),
    ], "Heavy Rain"),
}

ONLINE_CATEGORIES = {
    "day_type": ("day_of_week", [("weekend", "in (0, 6)")], "weekday"),
    "time_period": ("hour_of_day", [
        ("morning", "between 6 and 11"),
        ("afternoon", "between 12 and 17"),
        ("evening", "between 18 and 22"),
    ], "night"),
    "temperature_category": ("temperature_2m", [
        ("freezing", "< 0"),
        ("cold", "between 0 and 10"),
        ("mild", "between 10 and 20"),
    ], "warm"),
    "precipitation_category": ("precipitation", [
        ("none", "= 0"),
        ("light", "< 2.5"),
        ("moderate", "< 10"),
    ], "heavy"),
}

TEMPERATURE_LABELS = ["Freezing", "Cold", "Mild", "Warm", "Hot"]

# Fixed values. Model vocabulary, in the order of its ordinal codes.
MODEL_VOCABULARY = {
    "day_type": ["Weekday", "Weekend"],
    "time_period": ["morning", "afternoon", "evening", "night"],
    "temperature_category": ["cold", "cool", "moderate", "warm", "hot"],
    "precipitation_category": ["no_rain", "light_rain", "moderate_rain", "heavy_rain"],
}

# Fixed values. Online label -> model label.
MODEL_ALIASES = {
    "day_type": {"weekday": "Weekday", "weekend": "Weekend"},
    "precipitation_category": {
        "none": "no_rain", "light": "light_rain",
        "moderate": "moderate_rain", "heavy": "heavy_rain",
    },
}

# Fixed values. Model inputs in vector order, and the window sizes in hours.
PAST_HOURS = 48
HORIZON_HOURS = 24
MODEL_FEATURES = [
    "avg_free_spaces", "min_free_spaces", "max_free_spaces", "free_spaces_range",
    "hour_of_day", "day_of_week", "day_of_month", "calendar_week",
    "temperature_2m", "relative_humidity_2m", "precipitation", "month",
    "avg_free_spaces_rolling_24h", "avg_free_spaces_std_24h",
    "avg_free_spaces_diff_1h", "temperature_diff_1h",
    "day_type", "time_period", "temperature_category", "precipitation_category",
]
HYBRID_FEATURES = [
    "free_spaces", "occupancy_rate", "hour_of_day", "day_of_week", "is_weekend",
    "free_spaces_ma_3", "free_spaces_ma_6", "free_spaces_ma_12", "free_spaces_ma_24",
    "free_spaces_lag_1", "free_spaces_lag_2", "free_spaces_lag_3",
    "free_spaces_lag_6", "free_spaces_lag_12", "free_spaces_lag_24",
    "trend_1h", "trend_3h", "trend_6h", "hour_sin", "hour_cos",
]
MOVING_AVERAGE_ROWS = [3, 6, 12, 24]
LAG_ROWS = [1, 2, 3, 6, 12, 24]
TREND_ROWS = [1, 3, 6]

# Fixed values. Blend weight of the first model for horizons 1..24, per trained lot.
BLEND_WEIGHTS = {
    38: [0.9, 0.8, 0.65, 0.6, 0.55, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5,
         0.55, 0.55, 0.55, 0.6, 0.6, 0.6, 0.6, 0.65, 0.65, 0.65, 0.7, 0.7],
    634: [0.9, 0.75, 0.65, 0.5, 0.35, 0.4, 0.4, 0.4, 0.4, 0.4, 0.35, 0.35,
          0.35, 0.35, 0.4, 0.4, 0.4, 0.25, 0.2, 0.2, 0.35, 0.3, 0.25, 0.4],
}
CONFIDENCE = {"baseline": 0.85, "hybrid": 0.92}
HYBRID_LABELS = {
    38: "Linear Regression + Encoder-Decoder Neural Network",
    634: "Random Forest + Gradient Boosting",
}

# Fixed values. Availability classes: lowest share of free spaces, label, colour.
AVAILABILITY = [
    (0.5, "Very High", "#2ecc71"),
    (0.3, "High", "#f1c40f"),
    (0.15, "Low", "#e67e22"),
]
AVAILABILITY_OTHERWISE = ("Very Low", "#e74c3c")
DEFAULT_CAPACITY = 100

# Fixed values. WMO weather codes.
WEATHER_CODES = {
    0: "Clear", 1: "Mainly Clear", 2: "Partly Cloudy", 3: "Overcast",
    45: "Fog", 48: "Depositing Rime Fog",
    51: "Light Drizzle", 53: "Moderate Drizzle", 55: "Dense Drizzle",
    61: "Slight Rain", 63: "Moderate Rain", 65: "Heavy Rain",
    71: "Slight Snow", 73: "Moderate Snow", 75: "Heavy Snow",
    80: "Slight Showers", 81: "Moderate Showers", 82: "Violent Showers",
    95: "Thunderstorm", 96: "Thunderstorm with Hail", 99: "Thunderstorm with Heavy Hail",
}
# ---------------------------------------------------------------------------------------
