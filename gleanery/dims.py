"""Fixed dimension values and the literal tables built from them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# They decide results and are stated as they are.

DISTRICT = "Ratnapura"

DISTRICT_SLUGS = ["ratnapura", "ratnapura-district", "rathnapura", "ratnapura-sri-lanka"]

TOWNS = [
    "Ratnapura", "Embilipitiya", "Balangoda", "Pelmadulla", "Eheliyagoda",
    "Kuruwita", "Kalawana", "Nivithigala", "Rakwana", "Kahawatta",
    "Opanayaka", "Godakawela", "Weligepola", "Ayagama", "Elapatha",
    "Imbulpe", "Kolonna", "Kiriella", "Panadugama", "Kalthota",
    "Udawalawe", "Thanamalwila", "Balangoda Town", "Karawita", "Gillimale",
]

CATEGORIES = [
    "vehicles", "property", "electronics", "home-garden", "animals", "business-industry",
    "essentials", "jobs", "services", "education", "hobby-sport-kids", "agriculture",
]

PATH_TEMPLATES = [
    ("/{locale}/ads/{location}", "/{locale}/ads/{location}/{category}"),
    ("/{locale}/ads/sri-lanka/{location}", "/{locale}/ads/{location}/{category}"),
    ("/{locale}/{location}/ads", "/{locale}/{location}/ads/{category}"),
    ("/{locale}/ads?location={location}", "/{locale}/ads?location={location}&category={category}"),
]

GAZETTEER = [
    ("Ratnapura", [
        "ratnapura", "rathnapura", "eheliyagoda", "ahaliyagoda", "ehaliyagoda",
        "kuruwita", "pussella", "pelmadulla", "balangoda", "embilipitiya",
        "abilipitiya", "abililipitya", "rakwana", "kahawatta", "opanayaka",
        "kiriella", "nivithigala", "kalawana", "godakawela", "weligepola",
        "ayagama", "elapatha", "imbulpe", "kolonna", "belihuloya", "halpe",
        "pambahinna", "pambahinnda", "hidellana", "udawalawe", "udawalawa",
        "uda kandha", "gillimale", "karawita", "kalthota", "panadugama",
    ]),
    ("Kurunegala", [
        "dambadeniya", "giriulla", "wariyapola", "padeniya", "melsiripura",
        "polgahawela", "kurunegala", "narammala", "alawwa", "nikaweratiya",
    ]),
    ("Gampaha", [
        "nittambuwa", "attanagalla", "aththanagalla", "athanagalla", "kirindiwela",
        "kiridiwela", "wathupitiwala", "mirigama", "kiribathgoda", "bopitiya",
        "pasyala", "gampaha", "negombo", "ja-ela", "veyangoda", "divulapitiya",
    ]),
    ("Colombo", [
        "colombo", "mount lavinia", "meegoda", "hokandara", "thalawathugoda",
        "madiwala", "piliyandala", "nawagamuwa", "maharagama", "kottawa",
        "homagama", "dehiwala", "nugegoda", "pliyandala", "dampe",
    ]),
    ("Kalutara", ["kalutara", "wadduwa", "panadura", "horana", "beruwala", "hirana"]),
    ("Hambantota", ["hambantota", "walasmulla", "tangalle", "tissamaharama", "thanamalwila"]),
    ("Kegalle", ["kegalle", "kitulgala", "mawanella", "rambukkana", "warakapola"]),
    ("Badulla", ["badulla", "bandarawela", "welimada", "haputale", "ella", "kirimetitenna"]),
    ("Galle", ["galle", "hikkaduwa", "ambalangoda", "elpitiya"]),
    ("Matara", ["matara", "weligama", "akuressa", "deniyaya"]),
    ("Kandy", ["kandy", "peradeniya", "gampola", "katugastota", "digana"]),
    ("Ratnapura", [
        "රත්නපුර", "ඇහැලියගොඩ", "ඇහැළියගොඩ", "පැල්මඩුල්ල", "බලන්ගොඩ",
        "ඇඹිලිපිටිය", "ඇබිලිපිටිය", "කිරිඇල්ල", "උඩවලව", "හිදැල්ලන",
    ]),
    ("Kurunegala", ["දඹදෙණිය"]),
    ("Gampaha", ["නිට්ටඹුව", "වතුපිටිවල"]),
    ("Hambantota", ["වලස්මුල්ල", "වළස්මුල්ල"]),
]

CANONICAL_TOWNS = {
    "rathnapura": "Ratnapura", "රත්නපුර": "Ratnapura",
    "ahaliyagoda": "Eheliyagoda", "ehaliyagoda": "Eheliyagoda",
    "ඇහැලියගොඩ": "Eheliyagoda", "ඇහැළියගොඩ": "Eheliyagoda",
    "abilipitiya": "Embilipitiya", "abililipitya": "Embilipitiya",
    "ඇඹිලිපිටිය": "Embilipitiya", "ඇබිලිපිටිය": "Embilipitiya",
    "පැල්මඩුල්ල": "Pelmadulla", "බලන්ගොඩ": "Balangoda",
    "කිරිඇල්ල": "Kiriella", "හිදැල්ලන": "Hidellana",
    "udawalawa": "Udawalawe", "උඩවලව": "Udawalawe",
    "pambahinnda": "Pambahinna", "kiridiwela": "Kirindiwela",
    "aththanagalla": "Attanagalla", "athanagalla": "Attanagalla",
    "දඹදෙණිය": "Dambadeniya", "නිට්ටඹුව": "Nittambuwa", "වතුපිටිවල": "Wathupitiwala",
    "වලස්මුල්ල": "Walasmulla", "වළස්මුල්ල": "Walasmulla",
    "pliyandala": "Piliyandala",
}

HEADER_ALIASES = {
    "title": "title", "name": "title", "advert": "title",
    "size": "size", "land size": "size", "extent": "size", "area": "size",
    "location": "location", "location listed": "location", "district": "location",
    "price": "price", "asking price": "price",
    "link": "link", "url": "link", "ad": "link",
}

PRICE_QUALIFIERS = [
    "negotiable", "per month", "per day", "per week", "per year", "per perch",
    "per acre", "per hour", "onwards", "starting from", "fixed",
]

PERCHES_PER_ACRE = 160.0
SQM_PER_PERCH = 25.2929
MIN_PER_PERCH = 10_000.0
MAX_PER_PERCH = 5_000_000.0
MAX_TOTAL = 500_000_000.0
HIGH_PER_PERCH = 1_500_000.0
CITY_DISTRICTS = ["Colombo", "Gampaha", "Kalutara"]
OUTLIER_RATIO = 3.0
UNKNOWN = "(unknown)"
UNVERIFIED = "(unverified)"

# End of the fixed values.


def towns_by_rank() -> list[tuple[int, str, str]]:
    """(rank, town, district), longest town first, then in the order given."""
    first: dict[str, str] = {}
    for district, towns in GAZETTEER:
        for town in towns:
            first.setdefault(town, district)
    ordered = sorted(first.items(), key=lambda kv: -len(kv[0]))
    return [(i, town, district) for i, (town, district) in enumerate(ordered)]


def literal_map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def gazetteer(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(towns_by_rank(), "rank int, town string, district string")


def names(spark: SparkSession, values: list[str], column: str) -> DataFrame:
    """One row a value, with its place in the list."""
    return spark.createDataFrame(list(enumerate(values)), f"ord int, {column} string")


def first_of(candidates: list[Column]) -> Column:
    return reduce(lambda a, b: F.coalesce(a, b), candidates) if candidates else F.lit(None)
