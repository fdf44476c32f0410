"""Lookup tables, constants and column lists that results depend on."""

# Raw weather text per weather class, in lookup order. A text listed
# under two classes belongs to the first of them.
WEATHER_CLASSES = {
    "clear sky": ["Clear", "Fair", "Fair / Windy"],
    "few clouds": ["Partly Cloudy", "Partly Cloudy / Windy"],
    "scattered clouds": ["Scattered Clouds", "Mostly Cloudy", "Mostly Cloudy / Windy"],
    "broken clouds": ["Cloudy", "Cloudy / Windy", "Overcast", "Squalls / Windy"],
    "shower rain": [
        "Light Rain Showers", "Rain Showers", "Rain Shower", "Heavy Rain Showers",
        "Light Rain Shower", "Rain Shower / Windy", "Heavy Rain Shower / Windy",
        "Squalls", "Rain and Sleet", "Light Rain Shower / Windy",
        "Showers in the Vicinity", "Heavy Rain Shower", "Light Hail", "Small Hail", "Hail",
    ],
    "rain": [
        "Light Freezing Rain", "Heavy Rain", "Rain", "Rain / Windy", "Light Rain",
        "Light Rain with Thunder", "Heavy Rain / Windy", "Thunderstorms and Rain",
        "Light Rain / Windy", "Freezing Rain", "Light Freezing Rain / Windy",
        "Heavy Freezing Rain", "Heavy Freezing Rain / Windy", "Freezing Rain / Windy",
        "Light Drizzle", "Drizzle", "Rain and Sleet", "Drizzle and Fog",
        "Drizzle / Windy", "Light Drizzle / Windy", "Heavy Drizzle",
    ],
    "thunderstorm": [
        "Thunderstorm", "Heavy Thunderstorms and Snow", "Heavy Thunderstorms and Rain",
        "Heavy Thunderstorms with Small Hail", "Light Thunderstorms and Rain",
        "Light Thunderstorms and Snow", "Thunderstorms and Snow", "Light Thunderstorm",
        "Thunder", "Thunder in the Vicinity", "Thunder / Windy", "Thunder / Wintry Mix",
        "Thunder / Wintry Mix / Windy", "Thunder and Hail", "Thunder and Hail / Windy",
        "Heavy T-Storm / Windy", "T-Storm", "T-Storm / Windy", "Funnel Cloud",
        "Sleet and Thunder", "Tornado", "Heavy T-Storm",
    ],
    "snow": [
        "Blowing Snow", "Heavy Snow", "Snow", "Snow Showers", "Light Snow",
        "Light Snow / Windy", "Snow / Windy", "Heavy Snow / Windy", "Light Snow Shower",
        "Light Snow Showers", "Heavy Snow with Thunder", "Light Snow with Thunder",
        "Snow and Thunder", "Snow and Thunder / Windy", "Light Snow Grains",
        "Drifting Snow", "Drifting Snow / Windy", "Light Freezing Drizzle", "Snow Grains",
        "Heavy Ice Pellets", "Blowing Snow / Windy", "Heavy Blowing Snow",
        "Light Snow Shower / Windy", "Freezing Drizzle", "Blowing Snow Nearby",
        "Wintry Mix", "Light Snow and Sleet / Windy", "Low Drifting Snow",
        "Snow and Sleet / Windy", "Heavy Freezing Drizzle", "Wintry Mix / Windy",
        "Light Snow and Sleet", "Heavy Sleet and Thunder", "Light Blowing Snow",
        "Light Sleet / Windy", "Light Ice Pellets", "Ice Pellets", "Light Sleet",
        "Sleet", "Heavy Sleet", "Snow and Sleet", "Sleet / Windy", "Heavy Sleet / Windy",
    ],
    "mist": [
        "Mist", "Light Haze", "Haze", "Light Freezing Fog", "Fog", "Shallow Fog",
        "Fog / Windy", "Haze / Windy", "Partial Fog", "Partial Fog / Windy",
        "Mist / Windy", "Sand / Dust Whirls Nearby", "Duststorm", "Blowing Dust / Windy",
        "Shallow Fog / Windy", "Smoke / Windy", "Patches of Fog / Windy", "Blowing Sand",
        "Heavy Smoke", "Dust Whirls", "Smoke", "Volcanic Ash",
        "Sand / Dust Whirlwinds / Windy", "N/A Precipitation", "Patches of Fog", "Sand",
        "Sand / Dust Whirlwinds", "Widespread Dust / Windy", "Widespread Dust",
        "Sand / Windy", "Light Fog", "Blowing Dust",
    ],
}
UNKNOWN_CLASS = "Unknown"

# Icon number -> weather class; an icon is the number plus d (day) or n (night).
ICON_CLASSES = {
    "01": "clear sky",
    "02": "few clouds",
    "03": "scattered clouds",
    "04": "broken clouds",
    "09": "shower rain",
    "10": "rain",
    "11": "thunderstorm",
    "13": "snow",
    "50": "mist",
}
UNKNOWN_ICON_CLASS = "unknown"

# Column contracts.
ROAD_KEY = ["Street", "City", "County", "State"]
WEATHER_NUMBERS = ["Temperature(C)", "Humidity(%)", "Pressure(in)", "Wind_Speed(mph)"]
FLAGS = [
    "Amenity", "Crossing", "Give_Way", "Junction", "No_Exit", "Railway", "Stop",
    "Traffic_Calming", "Traffic_Signal",
]
CATEGORIES = ["highway", "Weather_Condition", "Sunrise_Sunset"]
FEATURES = WEATHER_NUMBERS + FLAGS + [f"{c}_indexed" for c in CATEGORIES]
CONDITIONS = WEATHER_NUMBERS + ["Weather_Condition"] + FLAGS + ["Sunrise_Sunset", "highway"]
LABEL = "row_count_norm"

# Map tag -> flag and search radius in metres. A null value accepts any value.
POI_RULES = [
    ("highway", "crossing", "Crossing", 30.0),
    ("highway", "give_way", "Give_Way", 30.0),
    ("railway", None, "Railway", 30.0),
    ("highway", "stop", "Stop", 30.0),
    ("traffic_calming", None, "Traffic_Calming", 30.0),
    ("highway", "traffic_signals", "Traffic_Signal", 30.0),
    ("amenity", None, "Amenity", 100.0),
    ("noexit", None, "No_Exit", 100.0),
    ("junction", None, "Junction", 100.0),
]

# Search distances and thresholds.
WAY_RADIUS_M = 600.0
EARTH_RADIUS_M = 6371000.0
MIN_NAME_SCORE = 70
TOP_CANDIDATES = 100
MAX_TRAINING_CONDITIONS = 220_000
RECENT_MINUTES = 15
TOP_ROADS = 5
WEATHER_REFRESH_SECONDS = 600
MAP_BOUNDS = {"min_lat": 37.43997, "min_lon": 14.94141, "max_lat": 37.64903, "max_lon": 15.20508}

# Unit factors.
HPA_TO_INHG = 0.02953
MPS_TO_MPH = 2.23694

# Forest settings.
FOREST_TREES = 40
FOREST_DEPTH = 11

# Demonstration weather settings, 3 x 3 x 18 x 2 x 2 = 648 combinations.
SCENARIO_HUMIDITY = [30, 40, 60]
SCENARIO_TEMPERATURE = [-10, 20, 30]
SCENARIO_ICONS = [n + part for part in "dn" for n in ICON_CLASSES]
SCENARIO_WIND = [1, 8]
SCENARIO_PRESSURE = [1010, 1020]
