"""Fixed values.

These must equal the values of the system this engine reproduces for its results
to agree (column names, widths, shifts, model parameters, lookbacks). They are
stated plainly here and imported everywhere else.
"""

# ---- fixed values: time model -------------------------------------------------
BUCKET_SECONDS = 300                       # width of a batch-view bucket
REPLAY_SHIFT_SECONDS = 251_129_400         # shift applied to a replayed price series
PREDICTION_LOOKBACK = "7 minutes"          # "current prediction" view
VIEW_LOOKBACK = "9 hours 30 minutes"       # "current batch row" and overlay views
KELVIN_OFFSET = 273.15
DROP_NAME_PREFIX_LENGTH = 19               # leading characters of a drop name ...
DROP_NAME_FORMAT = "yyyy-MM-dd-HH-mm-ss"   # ... parsed with this pattern
PRICE_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"  # price timestamp text

# ---- fixed values: weather readings (flattened, cleaned names) ----------------
# Columns dropped before the 8 averages of the batch view.
WEATHER_DROPPED = [
    "weather_0__icon", "base", "sys_type", "sys_id", "sys_country", "timezone", "id",
    "name", "cod", "weather_0__main", "weather_0__description", "coord_lon", "coord_lat",
    "main_temp_min", "main_temp_max", "sys_sunrise", "sys_sunset", "weather_0__id",
]
# Output alias -> averaged column, batch view.
WEATHER_AVERAGES = {
    "avg_temp": "main_temp",
    "avg_feels_like_temp": "main_feels_like",
    "avg_pressure": "main_pressure",
    "avg_humidity": "main_humidity",
    "avg_visibility": "visibility",
    "avg_wind_speed": "wind_speed",
    "avg_wind_deg": "wind_deg",
    "avg_clouds": "clouds_all",
}
# Output alias -> averaged column, exploration table; the last two are truncated to int.
EXPLORE_AVERAGES = {
    "avg_temp": "main_temp",
    "avg_feels_like_temp": "main_feels_like",
    "avg_min_temp": "main_temp_min",
    "avg_max_temp": "main_temp_max",
    "avg_pressure": "main_pressure",
    "avg_humidity": "main_humidity",
    "avg_visibility": "visibility",
    "avg_wind_speed": "wind_speed",
    "avg_wind_deg": "wind_deg",
    "avg_clouds": "clouds_all",
    "avg_sunrise": "sys_sunrise",
    "avg_sunset": "sys_sunset",
}
EXPLORE_TRUNCATED = ["avg_sunrise", "avg_sunset"]
# Output alias -> categorical column, exploration-table modes.
EXPLORE_MODES = {
    "mode_weather_id": "weather_0__id",
    "mode_weather_main": "weather_0__main",
    "mode_weather_desc": "weather_0__description",
}

# ---- fixed values: prices -----------------------------------------------------
PRICE_TIME_COLUMN = "Datetime__UTC_"
PRICE_LOCAL_TIME_COLUMN = "Datetime__Local_"
PRICE_VALUE_COLUMN = "Price__EUR_MWhe_"
PRICE_DROPPED = ["Country", "ISO3_Code", "Datetime__Local_"]
# Raw price message keys, in message order.
PRICE_MESSAGE_KEYS = ["Country", "ISO3 Code", "Datetime (UTC)", "Datetime (Local)", "Price (EUR/MWhe)"]
PRICE_STEP_SECONDS = 5                     # spacing of up-sampled price messages
PRICE_SOURCE_STEP_SECONDS = 3600           # spacing of the hourly price history
PRICE_RANGE_PERIODS = 721                  # timestamps generated per hourly pair

# ---- fixed values: model ------------------------------------------------------
# Batch-view name -> message feature name, used before training.
TRAINING_RENAMES = {
    "avg_temp": "main_temp",
    "avg_feels_like_temp": "main_feels_like",
    "avg_pressure": "main_pressure",
    "avg_humidity": "main_humidity",
    "avg_visibility": "visibility",
    "avg_wind_speed": "wind_speed",
    "avg_wind_deg": "wind_deg",
    "avg_clouds": "clouds_all",
    "avg_price": "price",
}
FEATURES_7 = ["main_temp", "main_pressure", "main_humidity", "visibility", "wind_speed", "wind_deg", "clouds_all"]
FEATURES_8 = ["main_temp", "main_feels_like", "main_pressure", "main_humidity", "visibility",
              "wind_speed", "wind_deg", "clouds_all"]
LABEL_COLUMN = "price"
ELASTIC_NET_PARAMS = {"maxIter": 10, "regParam": 0.3, "elasticNetParam": 0.8}
TRAIN_FRACTION_PERCENT = 70                # 70 / 30 train-test split
MODEL_RELOAD_SECONDS = 3600                # scoring run before the newest model is reloaded

# ---- fixed values: batch view and prediction tables --------------------------
BATCH_VIEW_COLUMNS = ["dt", "avg_clouds", "avg_feels_like_temp", "avg_humidity", "avg_pressure",
                      "avg_price", "avg_temp", "avg_visibility", "avg_wind_deg", "avg_wind_speed"]
PREDICTION_COLUMNS = ["dt", "prediction"]

# ---- fixed values: city list --------------------------------------------------
CITY_COLUMNS = ["Geoname ID", "Name", "ASCII Name", "Country name EN", "Coordinates"]
DEFAULT_COUNTRY = "Belgium"
