"""Names and fixed values shared by all operators."""

# Column names. Raw files call them PM2.5, TEMP, ...; tables use lower snake case.
STATION, TS, DATE = "station", "ts", "date"
TARGET = "pm2_5"
POLLUTANTS = ("pm2_5", "pm10", "so2", "no2", "co", "o3")
WEATHER = ("temp", "pres", "dewp", "rain", "wspm")
CHANNELS = POLLUTANTS + WEATHER
WIND = "wd"
CLOCK_PARTS = ("year", "month", "day", "hour")

# Header of a station file, in its canonical order.
RAW_HEADER = ("No", "year", "month", "day", "hour", "PM2.5", "PM10", "SO2", "NO2", "CO", "O3",
              "TEMP", "PRES", "DEWP", "RAIN", "wd", "WSPM", "station")
RAW_FILE_PATTERN = "PRSA_*.csv"
MISSING_MARKS = ("", "NA", "N/A", "NaN", "nan", "NULL", "null", "None")

# Feature windows.
HOURLY_LAGS = (1, 2, 3, 24, 168)
HOURLY_WINDOWS = (3, 24, 168)
DAILY_LAGS = (1, 2, 3, 7)
DAILY_ROLLS = ((7, 3), (30, 10))       # (rows, least non-null rows)
HEATING_MONTHS = (11, 12, 1, 2, 3)
SEASONS = ("Winter", "Spring", "Summer", "Autumn")   # index = month % 12 div 3

# Daily PM2.5 bands; a band holds its upper edge.
CATEGORY_EDGES = (12.0, 35.4, 55.4, 150.4, 250.4)
CATEGORIES = ("Good", "Moderate", "USG", "Unhealthy", "Very Unhealthy", "Hazardous")
N_CLASSES = len(CATEGORIES)

# Station type, latitude, longitude.
STATION_META = {
    "Aotizhongxin": ("urban", 39.982, 116.397),
    "Changping": ("suburban", 40.217, 116.230),
    "Dingling": ("background", 40.292, 116.220),
    "Dongsi": ("urban", 39.929, 116.417),
    "Guanyuan": ("urban", 39.929, 116.339),
    "Gucheng": ("urban", 39.911, 116.184),
    "Huairou": ("suburban", 40.328, 116.628),
    "Nongzhanguan": ("urban", 39.937, 116.461),
    "Shunyi": ("suburban", 40.127, 116.655),
    "Tiantan": ("urban", 39.886, 116.407),
    "Wanliu": ("urban", 39.987, 116.287),
    "Wanshouxigong": ("urban", 39.878, 116.352),
}
STATION_TYPES = ("urban", "suburban", "background")

# Compass labels.
WIND_LABELS = {
    "N": "North", "NNE": "North-Northeast", "NE": "Northeast", "ENE": "East-Northeast",
    "E": "East", "ESE": "East-Southeast", "SE": "Southeast", "SSE": "South-Southeast",
    "S": "South", "SSW": "South-Southwest", "SW": "Southwest", "WSW": "West-Southwest",
    "W": "West", "WNW": "West-Northwest", "NW": "Northwest", "NNW": "North-Northwest",
}

# The 29 inputs of the next-day classifier, in model order.
FEATURES = (
    "pm_today", "pm_lag1", "pm_lag2", "pm_lag3", "pm_lag7",
    "pm_roll7_mean", "pm_roll7_std", "pm_roll30_mean", "pm_roll30_std", "pm_dev7",
    "pm10_today", "so2_today", "no2_today", "co_today", "o3_today",
    "pm10_lag1", "no2_lag1", "co_lag1",
    "temp", "pres", "dewp", "wspm", "rain",
    "t_month_sin", "t_month_cos", "t_doy_sin", "t_doy_cos", "t_is_weekend", "t_is_heating",
)
LAG_FEATURES = FEATURES[:5]
