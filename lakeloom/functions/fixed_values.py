"""Word lists, labels and constants that results depend on.

Everything in this file is data. Rules are ordered; the first one that holds decides.
"""

from __future__ import annotations

# --- fixed values: aircraft maker by name prefix (case-insensitive), else "Other" ---------
MAKER_PREFIXES = [
    ("Airbus", "Airbus"),
    ("Boeing", "Boeing"),
    ("Antonov", "Antonov"),
    ("Bombardier", "Bombardier"),
    ("Embraer", "Embraer"),
    ("Cessna", "Cessna"),
    ("De Havilland", "De Havilland"),
    ("McDonnell Douglas", "McDonnell Douglas"),
    ("British Aerospace", "British Aerospace"),
    ("Dassault", "Dassault"),
    ("Fokker", "Fokker"),
    ("Lockheed", "Lockheed"),
    ("Tupolev", "Tupolev"),
    ("Ilyushin", "Ilyushin"),
    ("Gulfstream", "Gulfstream"),
    ("Gulfstream/Rockwell", "Gulfstream"),
    ("Canadair", "Canadair"),
    ("BAe", "British Aerospace (BAe)"),
    ("Avro", "Avro"),
    ("Shorts", "Shorts"),
    ("Fairchild", "Fairchild Dornier"),
    ("Aerospatiale", "Aerospatiale"),
    ("Pilatus", "Pilatus"),
    ("Piper", "Piper"),
    ("Sikorsky", "Sikorsky"),
    ("Learjet", "Learjet"),
    ("COMAC", "COMAC"),
    ("Saab", "Saab"),
    ("Partenavia", "Partenavia"),
    ("NAMC", "NAMC"),
    ("Beechcraft", "Beechcraft"),
    ("Harbin", "Harbin"),
    ("Bell", "Bell"),
    ("Hawker Siddeley", "Hawker Siddeley"),
]
MAKER_DEFAULT = "Other"

# --- fixed values: character group by leading word (case-insensitive), else "Other" --------
CHARACTER_LEADS = ["Rick", "Morty", "Summer", "Beth", "Jerry"]
CHARACTER_DEFAULT = "Other"

# --- fixed values: episode group by contained text (case-insensitive), else "Other" --------
# (label, "any" | "all", texts)
EPISODE_TEXTS = [
    ("Rick-Focused", "any", ["ricklantis", "rickmurai", "pickle rick", "rickternal"]),
    ("Morty-Focused", "any", ["morty", "mort"]),
    ("Interdimensional Cable", "any", ["interdimensional cable", "rixty minutes"]),
    ("Rick & Morty Duo", "all", ["rick", "mort"]),
    (
        "Pop Culture Reference",
        "any",
        ["park", "shaym", "recall", "galactica", "jack", "tomorty", "spotless"],
    ),
]
EPISODE_DEFAULT = "Other"

# --- fixed values: location category by lower-cased type, else "Unknown" -------------------
LOCATION_TYPES = [
    (
        "Celestial Body",
        ["planet", "asteroid", "quasar", "mount", "elemental rings", "dwarf planet (celestial dwarf)"],
    ),
    (
        "Artificial World",
        [
            "teenyverse",
            "miniverse",
            "microverse",
            "diegesis",
            "non-diegetic alternative reality",
            "box",
            "machine",
        ],
    ),
    (
        "Virtual/Simulated",
        ["game", "dream", "memory", "tv", "consciousness", "nightmare", "fantasy town"],
    ),
    (
        "Location Type",
        [
            "space station",
            "resort",
            "spa",
            "base",
            "police department",
            "customs",
            "daycare",
            "spacecraft",
            "arcade",
        ],
    ),
    ("Abstract Realm", ["hell", "reality", "liquid", "death star", "artificially generated world"]),
    ("Social Structure", ["country", "cluster", "menagerie", "convention"]),
    ("Quadrant/Zone", ["quadrant"]),
]
LOCATION_DEFAULT = "Unknown"

# --- fixed values: dimension group, else "Other" -------------------------------------------
# (label, "contains" | "starts", texts), case-insensitive
DIMENSION_TEXTS = [
    ("Unclassified", "contains", ["unknown"]),
    ("Standard Format", "starts", ["dimension c"]),
    ("Fascist Variant", "contains", ["Fascist"]),
    (
        "Thematic",
        "contains",
        [
            "Magic",
            "Fantasy",
            "Post-Apocalyptic",
            "Merged",
            "Evil Rick",
            "Testicle",
            "Eric Stoltz",
            "Wasp",
            "Phone",
            "Spider",
            "Pizza",
            "Chair",
            "Tusk",
            "Cromulon",
        ],
    ),
    ("Canonical Named", "contains", ["Replacement", "Cronenberg"]),
]
DIMENSION_DEFAULT = "Other"

# --- fixed values: keys, markers, zones, bounds ---------------------------------------------
NULL_KEY_TEXT = "_dbt_utils_surrogate_key_null_"
MISSING = "\\N"  # backslash, capital N
NEWLINE_TEXT = "\\n"  # backslash, small n: two characters, not a line break
MELBOURNE = "Australia/Melbourne"
SYDNEY = "Australia/Sydney"
GEO_COUNTRIES = ["New Zealand", "United Kingdom", "Australia", "Canada", "France"]
CALENDAR_FIRST, CALENDAR_LAST = "2000-01-01", "2029-12-31"
TRAILING_ROWS = 14
MISSING_DATE_LIMIT = 6
BOOK_PAGE_SIZE = 100
WEATHER_FIRST_DAY = "2021-01-01"

# --- fixed values: headers of the header-less aviation files -------------------------------
AVIATION_HEADERS = {
    "airlines": ["Airline ID", "Name", "Alias", "IATA", "ICAO", "Callsign", "Country", "Active"],
    "airports": [
        "Airport ID",
        "Name",
        "City",
        "Country",
        "IATA",
        "ICAO",
        "Latitude",
        "Longitude",
        "Altitude",
        "Timezone",
        "DST",
        "Tz database time zone",
        "Type",
        "Source",
    ],
    "routes": [
        "Airline",
        "Airline ID",
        "Source airport",
        "Source airport ID",
        "Destination airport",
        "Destination airport ID",
        "Codeshare",
        "Stops",
        "Equipment",
    ],
    "planes": ["Name", "IATA", "ICAO"],
}

# --- fixed values: accepted values of the checks --------------------------------------------
ALCOHOLIC_TYPES = ["Non alcoholic", "Optional alcohol", "Alcoholic"]
COUNTRY_CODES = ["AU", "NZ", "CA", "GB"]
CHARACTER_STATUSES = ["Alive", "unknown", "Dead"]
CHARACTER_GENDERS = ["Genderless", "Male", "Female", "unknown"]

# --- fixed values: statuses a load can end with ----------------------------------------------
LOADED, UNCHANGED, SKIPPED, FAILED = "success", "skipped_no_new_data", "skipped", "failed"

# --- fixed values: places whose weather is followed -------------------------------------------
# (city, latitude, longitude, time zone, country)
WEATHER_PLACES = [
    ("Sydney", -33.8688, 151.2093, "Australia/Sydney", "Australia"),
    ("Melbourne", -37.8136, 144.9631, "Australia/Melbourne", "Australia"),
    ("Brisbane", -27.4698, 153.0251, "Australia/Brisbane", "Australia"),
    ("Perth", -31.9505, 115.8605, "Australia/Perth", "Australia"),
    ("Adelaide", -34.9285, 138.6007, "Australia/Adelaide", "Australia"),
    ("Canberra", -35.2809, 149.1300, "Australia/Sydney", "Australia"),
    ("Hobart", -42.8821, 147.3272, "Australia/Hobart", "Australia"),
    ("Darwin", -12.4634, 130.8456, "Australia/Darwin", "Australia"),
    ("Cairns", -16.92366, 145.76613, "Australia/Brisbane", "Australia"),
    ("Alice Springs", -23.697479, 133.883621, "Australia/Darwin", "Australia"),
    ("Albany", -35.02692, 117.88369, "Australia/Perth", "Australia"),
    ("Palmerston North", -40.3563556918218, 175.61113357543945, "Pacific/Auckland", "New Zealand"),
    ("Wellington", -41.2865, 174.7762, "Pacific/Auckland", "New Zealand"),
    ("Auckland", -36.8485, 174.7633, "Pacific/Auckland", "New Zealand"),
    ("Christchurch", -43.5321, 172.6362, "Pacific/Auckland", "New Zealand"),
]
# the first eight of them also have a UV feed
UV_PLACES = 8
