"""Fixed values and sample rule tables.

Fixed values are constants whose exact text the curated output depends on.
Rule tables (keyword lists, type tables, lookups) are parameters of a run; the
samples here are small stand-ins used by tests and the query catalogue.
"""

# ---- fixed values -------------------------------------------------------
FEED_ID = 11
ID_PREFIX = "BC-"
DEFAULT_CURRENCY = "USD"
LANGUAGES = ["en-us", "fr", "es", "de"]
ENGLISH_CODES = ["en-us", "en-gb"]
COUNTRY_REMAP = {"XA": "GE", "XY": "CY"}
COUNTRY_NAME_REMAP = {"United States": "USA"}
SHARED_ROOM_KEYWORDS = ["shared room", "room shared", "bathroom", "dormitory", "hostel"]
SHARED_SPACE_KEYWORDS = ["apartment", "flat", "house", "home", "condo"]
AFFILIATE_SUFFIX = "=affiliate_id"
CHILD_FRIENDLY_TAG = "Child Friendly"
OTHER_CATEGORY = "Other"
PRICE_NIGHTS = 3
# ------------------------------------------------------------------------

# ---- sample rule tables (parameters) -------------------------------------
# Flag -> keywords, matched as substrings of normalised text (U4).
KEYWORD_LISTS = {
    "is_all_inclusive_type": ["all inclusive", "allinclusive", "full board"],
    "is_hotel_type": ["hotel", "resort", "motel", "inn "],
    "is_promoting_escort": ["escort"],
    "is_work_friendly": ["wifi", "desk", "workspace", "work "],
    "is_business_travel": ["business", "conference", "meeting"],
}

# Flag -> keywords for the prose in the driver's documents table.
DOC_KEYWORDS = {
    "english_marker": ["the ", " and "],
    "french_marker": [" le ", " les "],
    "german_marker": [" der ", " und "],
    "spanish_marker": [" el ", " los "],
    "mentions_hotel": ["hotel", "resort"],
}

# Part-name keyword classes (regex alternation, first match wins).
PART_CLASSES = [("Round part", ["ring", "plate", "gear"]), ("Gadget", ["widget", "gizmo"])]

# Word slug -> category or list of categories (amenity synonyms shape).
WORD_SYNONYMS = {
    "the": "english", "and": ["english", "connector"], "der": "german",
    "und": ["german", "connector"], "le": "french", "et": ["french", "connector"],
    "el": "spanish", "y": ["spanish", "connector"], "de": ["french", "spanish"],
    "la": ["french", "spanish"],
}

# Line codes -> display names (unknown codes are dropped).
CODE_NAMES = {"R": "Returned item", "A": "Accepted", "F": "Filled", "O": "Open order"}

# Accommodation-type code -> property type; property type -> category.
PART_TYPE_TO_PROPERTY = {"ECONOMY": "Hostel", "SMALL": "Apartment", "MEDIUM": "Hotel",
                         "PROMO": "Resort", "STANDARD": "Guest house"}
PROPERTY_CATEGORY = {"Hotel": "Hotel", "Resort": "Hotel", "Apartment": "Apartment",
                     "Hostel": "Hostel"}

# Enabled locales: language name -> {code, disabled}.
LOCALES = {
    "English": {"code": "en", "disabled": False},
    "French": {"code": "fr", "disabled": False},
    "German": {"code": "de", "disabled": False},
    "Spanish": {"code": "es", "disabled": True},
}

# Words kept by the meal-plan style array clean-up.
MEAL_WORDS = ["the", "and", "of", "de", "la"]

# ---- sample reference lookups (parameters; built from a rule) -------------
THEMES = {i: {"name": {"en-us": n}} for i, n in enumerate(["Beach", "City", "Family", "Ski", "Wellness"])}

FACILITY_TYPE_NAMES = ["general_services", "food_and_drink", "wellness", "outdoors"]
FACILITY_TYPES = {
    i: {"name": {"en-us": n, "fr": n.upper() if i % 2 == 0 else None, "fallback": n}}
    for i, n in enumerate(FACILITY_TYPE_NAMES)
}

# Facility i (0-19) belongs to type i % 4; French names only for even ids,
# German only below 10, no names at all for id 19.
FACILITIES = {
    i: {"facility_type": i % 4,
        "name": ({} if i == 19 else {"en-us": f"Facility {i}", "fr": f"Equipement {i}" if i % 2 == 0 else None,
                                     "de": f"Ausstattung {i}" if i < 10 else "", "fallback": f"Facility {i}"})}
    for i in range(20)
}

# Amenity slug (per-character slug of the English name) -> category or categories.
AMENITY_SYNONYMS = {f"facility-{i}": (["Comfort", "Services"] if i % 3 == 0 else "Comfort" if i % 3 == 1 else "Leisure")
                    for i in range(0, 20, 2)}

BED_TYPES = {0: {"name": {"en-us": "Single bed", "fr": "Lit simple", "es": "Cama individual", "de": "Einzelbett"}},
             1: {"name": {"en-us": "Double bed", "fr": "Lit double", "de": "Doppelbett"}},
             2: {"name": {"en-us": "Sofa bed"}}}

# Label -> keywords over normalised "name type category" text.
CATEGORY_RULES = {"Budget": ["hostel", "dormitory"], "Family": ["apartment", "house", "condo"],
                  "Luxury": ["resort", "suites"]}
