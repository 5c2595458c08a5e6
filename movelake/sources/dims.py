"""Small fixed dimension tables (feed endpoint lists), broadcast in joins.

Their size is fixed by the feeds, not by data volume, so broadcasting them is
always safe.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# Radial-query grid of the regional aircraft feed, in poll
# order (name, latitude, longitude); every query uses a 250 nm radius.
REGION_GRID = [
    ("eu-central", 50, 10), ("eu-west", 48, -2), ("eu-east", 52, 20), ("eu-south", 42, 12),
    ("eu-north", 60, 15), ("uk", 52, -1), ("spain", 40, -4), ("turkey", 39, 32),
    ("greece", 38, 24), ("scandinavia", 63, 10), ("russia-west", 56, 38),
    ("us-northeast", 42, -72), ("us-east", 35, -80), ("us-southeast", 28, -82),
    ("us-central", 40, -95), ("us-midwest", 42, -88), ("us-southwest", 33, -112),
    ("us-west", 37, -120), ("us-northwest", 47, -122), ("us-south", 30, -95),
    ("us-florida", 26, -80), ("canada-east", 45, -75), ("canada-west", 49, -123),
    ("canada-central", 51, -114), ("mexico", 19, -99), ("caribbean", 18, -66),
    ("japan", 35, 139), ("korea", 37, 127), ("china-east", 31, 121), ("china-north", 40, 116),
    ("china-south", 23, 113), ("hongkong", 22, 114), ("taiwan", 25, 121),
    ("philippines", 14, 121), ("thailand", 14, 100), ("singapore", 1, 104),
    ("indonesia", -6, 107), ("malaysia", 3, 101), ("vietnam", 21, 106),
    ("india-north", 28, 77), ("india-south", 13, 77), ("india-west", 19, 73),
    ("uae", 25, 55), ("qatar", 25, 51), ("saudi", 24, 46), ("israel", 32, 35),
    ("iran", 35, 51), ("australia-east", -33, 151), ("australia-north", -12, 131),
    ("australia-west", -32, 116), ("newzealand", -41, 175), ("brazil-south", -23, -46),
    ("brazil-north", -3, -60), ("argentina", -34, -58), ("chile", -33, -71),
    ("colombia", 4, -74), ("peru", -12, -77), ("south-africa", -26, 28), ("egypt", 30, 31),
    ("morocco", 34, -6), ("nigeria", 6, 3), ("kenya", -1, 37), ("ethiopia", 9, 39),
]
REGION_RADIUS_NM = 250
NM_KM = 1.852

# Aircraft type codes polled by the type feed, in poll order.
AIRCRAFT_TYPES = [
    "A319", "A320", "A321", "A20N", "A21N", "A330", "A332", "A333", "A339", "A350",
    "A359", "A35K", "A388", "B737", "B738", "B739", "B38M", "B39M", "B752", "B763",
    "B772", "B77W", "B788", "B789", "B78X", "E170", "E190", "E195", "CRJ9", "CRJ7",
    "B744", "B748", "C17", "C130", "A400",
]

# Endpoints of the three-endpoint aircraft feed, in poll order.
ADSB_ENDPOINTS = ["ladd", "mil", "pia"]

# Orbital-element categories, in poll order.
ORBIT_CATEGORIES = [
    "stations", "starlink", "oneweb", "planet", "spire", "iridium-NEXT", "globalstar",
    "orbcomm", "intelsat", "ses", "geo", "gps-ops", "galileo", "glonass", "beidou",
    "weather", "resource", "active", "visual", "amateur", "cubesat", "science",
    "engineering", "education",
]

# Source names written into flights.source per feed.
FLIGHT_SOURCES = {
    "state_vectors": "opensky", "adsb_endpoints": "adsblol", "adsb_regions": "airplaneslive",
    "adsb_types": "adsbone", "adsb_snapshot": "adsbfi", "private_feeder": "private",
}

# Station-id prefixes of the three departure-board feeds.
STATION_PREFIX = {"ch": "sbb:", "be": "be:", "at": "at:"}

# Stations polled by the three departure-board feeds, in poll
# order (endpoint id, name).
STATIONS = {
    "ch": [
        ("8503000", "Zürich HB"), ("8507000", "Bern"), ("8500010", "Basel SBB"), ("8501120", "Genève"),
        ("8501008", "Lausanne"), ("8505000", "Luzern"), ("8506302", "Winterthur"), ("8506000", "St. Gallen"),
        ("8503006", "Zürich Flughafen"), ("8503504", "Olten"), ("8502113", "Aarau"), ("8504300", "Biel/Bienne"),
        ("8504100", "Fribourg/Freiburg"), ("8502204", "Zug"), ("8505400", "Locarno"), ("8505300", "Lugano"),
        ("8508100", "Bellinzona"), ("8509000", "Chur"), ("8507483", "Interlaken Ost"), ("8501300", "Montreux"),
        ("8507493", "Interlaken West"), ("8501400", "Aigle"), ("8500090", "Basel Bad Bf"), ("8506112", "Rapperswil SG"),
        ("8505004", "Arth-Goldau"), ("8502202", "Zug Oberwil"), ("8509404", "Zermatt"), ("8503503", "Baden"),
        ("8506121", "Wil SG"), ("8502007", "Zürich Oerlikon"), ("8503003", "Zürich Stadelhofen"),
        ("8503016", "Zürich Hardbrücke"), ("8503010", "Zürich Enge"), ("8507002", "Bern Wankdorf"),
        ("8504421", "Biel Mett"), ("8506349", "Schaffhausen"), ("8509073", "Davos Platz"), ("8509072", "Davos Dorf"),
        ("8500309", "Brugg AG"), ("8500218", "Liestal"), ("8501026", "Genève-Aéroport"), ("8501007", "Lausanne-Flon"),
        ("8508419", "Sion"), ("8500501", "Neuchâtel"), ("8506300", "Kreuzlingen"), ("8507785", "Thun"),
        ("8506009", "Gossau SG"),
    ],
    "be": [
        ("BE.NMBS.008814001", "Brussel-Zuid"), ("BE.NMBS.008813003", "Brussel-Noord"),
        ("BE.NMBS.008812005", "Brussel-Centraal"), ("BE.NMBS.008821006", "Antwerpen-Centraal"),
        ("BE.NMBS.008892007", "Gent-Sint-Pieters"), ("BE.NMBS.008841004", "Liège-Guillemins"),
        ("BE.NMBS.008891009", "Brugge"), ("BE.NMBS.008872009", "Charleroi-Central"), ("BE.NMBS.008844008", "Namur"),
        ("BE.NMBS.008831005", "Leuven"), ("BE.NMBS.008821121", "Antwerpen-Berchem"), ("BE.NMBS.008891702", "Oostende"),
        ("BE.NMBS.008893120", "Kortrijk"), ("BE.NMBS.008833001", "Mechelen"), ("BE.NMBS.008861002", "Hasselt"),
        ("BE.NMBS.008843000", "Mons"), ("BE.NMBS.008819406", "Brussels Airport"),
        ("BE.NMBS.008892601", "Gent-Dampoort"), ("BE.NMBS.008811916", "Schaarbeek"), ("BE.NMBS.008815040", "Midi"),
    ],
    "at": [
        ("8100002", "Wien Hbf"), ("8100003", "Wien Meidling"), ("8100008", "Wien Praterstern"),
        ("8100353", "Wien Floridsdorf"), ("8100173", "Salzburg Hbf"), ("8100013", "Linz Hbf"), ("8100101", "Graz Hbf"),
        ("8100108", "Innsbruck Hbf"), ("8100020", "Klagenfurt Hbf"), ("8100085", "St. Pölten Hbf"),
        ("8100050", "Villach Hbf"), ("8100041", "Bregenz"), ("8100017", "Wels Hbf"), ("8100079", "Leoben Hbf"),
        ("8100061", "Wiener Neustadt Hbf"), ("8100037", "Krems an der Donau"), ("8100113", "Feldkirch"),
        ("8100024", "Attnang-Puchheim"), ("8100063", "Bruck an der Mur"), ("8100128", "Dornbirn"),
    ],
}

# GTFS-RT enum names (alert cause / effect) by number.
ALERT_CAUSE = {
    1: "UNKNOWN_CAUSE", 2: "OTHER_CAUSE", 3: "TECHNICAL_PROBLEM", 4: "STRIKE",
    5: "DEMONSTRATION", 6: "ACCIDENT", 7: "HOLIDAY", 8: "WEATHER", 9: "MAINTENANCE",
    10: "CONSTRUCTION", 11: "POLICE_ACTIVITY", 12: "MEDICAL_EMERGENCY",
}
ALERT_EFFECT = {
    1: "NO_SERVICE", 2: "REDUCED_SERVICE", 3: "SIGNIFICANT_DELAYS", 4: "DETOUR",
    5: "ADDITIONAL_SERVICE", 6: "MODIFIED_SERVICE", 7: "OTHER_EFFECT", 8: "UNKNOWN_EFFECT",
    9: "STOP_MOVED",
}


def region_grid(spark: SparkSession) -> DataFrame:
    rows = [(i, n, float(a), float(b)) for i, (n, a, b) in enumerate(REGION_GRID)]
    schema = T.StructType([
        T.StructField("region_idx", T.IntegerType(), False),
        T.StructField("region", T.StringType(), False),
        T.StructField("r_lat", T.DoubleType(), False),
        T.StructField("r_lon", T.DoubleType(), False),
    ])
    return spark.createDataFrame(rows, schema)


def indexed_list(spark: SparkSession, values, name: str) -> DataFrame:
    schema = T.StructType([
        T.StructField(f"{name}_idx", T.IntegerType(), False),
        T.StructField(name, T.StringType(), False),
    ])
    return spark.createDataFrame(list(enumerate(values)), schema)


def stations(spark: SparkSession, feed: str) -> DataFrame:
    """The feed's station list (JOIN-2): endpoint, station_name."""
    listed = F.array(*[F.struct(F.lit(e).alias("endpoint"), F.lit(n).alias("station_name")) for e, n in STATIONS[feed]])
    return spark.range(1).select(F.inline(listed))
