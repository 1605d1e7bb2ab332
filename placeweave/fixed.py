"""Fixed values.

Everything in this module is a word list, constant or text pattern that has to
keep exactly this value for results to come out right.  No logic lives here.
"""

# Stop words of the filtered tokeniser.
STOP_WORDS = [
    "the", "a", "an", "of", "in", "on", "at", "to", "from", "by", "with", "and", "or", "for",
    "tour", "trip", "visit", "guide", "guided", "ticket", "entry", "skip", "line",
    "day", "half", "full", "hour", "hours", "min", "mins",
    "private", "group", "walking", "boat", "bus", "train",
    "museum", "park", "palace", "castle", "cathedral", "church", "basilica", "tower",
    "center", "centre", "city", "town", "village", "street", "square", "plaza",
    "food", "wine", "tasting", "lunch", "dinner", "breakfast", "meal", "drink",
    "show", "concert", "performance", "experience", "adventure", "activity",
    "transfer", "transport", "pickup", "dropoff", "airport", "port", "station",
    "hotel", "accommodation", "stay", "night", "nights",
    "o", "a", "os", "as", "um", "uma", "uns", "umas",
    "de", "do", "da", "dos", "das", "em", "no", "na", "nos", "nas",
    "por", "pelo", "pela", "pelos", "pelas", "para", "com", "e", "ou", "que",
    "entrance", "admission", "access", "priority", "fast", "track",
]

# Query-time synonyms.
SYNONYMS = {
    "ticket": ["entry", "admission", "pass", "access"],
    "bus": ["shuttle", "transport", "coach", "hop-on"],
    "tour": ["trip", "excursion", "visit", "guide"],
    "show": ["performance", "concert", "dance", "event"],
    "walking": ["foot", "stroll", "pedestrian"],
    "museum": ["gallery", "exhibition"],
    "guide": ["host", "instructor", "leader"],
}

# Boosts of the search clauses.
FIELD_BOOSTS = {"title": 5.0, "click_text": 3.0, "wiki_text": 1.5, "city": 8.0}
SYNONYM_BOOSTS = {"click_text": 2.5, "wiki_text": 1.2}
FUZZY_BOOST = 1.0
PHRASE_BOOST = 4.0
PHRASE_SLOP = 10
WEAK_FUZZY_MIN_LENGTH = 4
CANDIDATES = 50
PAGE_SIZE = 10

# BM25.
BM25_K1 = 1.2
BM25_B = 0.75

# Infobox names that mark a landmark page.
LANDMARK_INFOBOXES = [
    "building", "landmark", "museum", "monument", "park", "bridge",
    "tourist attraction", "church", "temple", "castle", "city", "square", "cathedral",
    "settlement", "place", "district", "country", "river", "island", "mountain", "forest",
    "gallery", "geography", "hotel", "stadium", "arena", "theatre", "airport", "railway",
    "station", "library", "university", "college", "market", "zoo", "aquarium", "cemetery",
    "palace", "building_complex", "mosque", "synagogue", "shrine", "monastery", "basilica",
    "lake", "waterfall", "cave", "valley", "volcano", "bay", "peninsula", "desert", "beach",
    "cliff", "national_park", "heritage_site", "archaeological_site", "exhibit", "memorial",
    "artwork", "sculpture", "museum_ship", "observatory", "tunnel", "dam", "lighthouse",
    "port", "harbor", "harbour", "road", "highway", "viaduct", "fort", "fortress", "bunker",
    "citadel", "barracks", "watchtower", "gatehouse", "manor", "mansion", "villa", "chateau",
    "hall", "residence", "tourist_attraction", "theme_park", "amusement_park",
    "botanical_garden", "structure",
]

# Infobox names that mark a city page.
CITY_INFOBOXES = ["city", "town", "settlement", "village", "municipality"]

# Infobox keys feeding each record field, first non-empty one wins.
FIELD_SOURCES = {
    "location": ["location"],
    "country": ["country"],
    "coordinates": ["coordinates", "coord"],
    "built": ["built", "opened", "established", "completed", "founded"],
    "architect": ["architect", "developer", "designer"],
    "style": ["style", "architectural_style"],
    "height": ["height"],
}

# Category words deciding the page type, first hit wins.
TYPE_WORDS = [
    ("museum", ["museum"]),
    ("park", ["park", "garden"]),
    ("bridge", ["bridge"]),
    ("monument", ["monument"]),
    ("river", ["river"]),
    ("city", ["city", "town", "settlement"]),
    ("landmark", ["castle", "building", "tower", "church"]),
]
DEFAULT_TYPE = "place"

WIKI_BASE = "https://en.wikipedia.org/wiki/"

# Text patterns of wiki markup.
CATEGORY = r"(?i)\[\[Category:([^\]|]+)"
REDIRECT = r"(?i)#REDIRECT\s*\[\[([^\]]+)\]\]"
COMMENT = r"(?s)<!--.*?-->"
REF_TAG = r"(?is)<ref\b[^>]*>.*?</ref>|<ref\b[^>]*/>"
TEMPLATE = r"\{\{[^{}]*\}\}"
START_DATE = r"(?i)\{\{\s*start\s*date[^}]*\}\}"
QUOTE_RUN = r"''+"
TABLE = r"(?s)\{\|.*?\|\}"
WIKILINK = r"\[\[(?:[^|\]]*\|)?([^\]]+)\]\]"
LABELLED_LINK = r"\[http[^\s]+ ([^\]]+)\]"
BARE_LINK = r"\[http[^\s]+\]"
FILE_LINK = r"(?i)\[\[(?:File|Image):(?:[^\[\]]|\[\[[^\[\]]*\]\])*\]\]"
HEADING = r"(?m)^[ \t]*=+[^=\n]+=+[ \t]*$"
INFOBOX_NAME = r"(?i)\{\{\s*Infobox\s*([^\n|{]+)"
PLACE_IN_CATEGORY = r"\b(?:in|of)\s+([A-Z][A-Za-z.\- ]{2,40})"
PLACE_IN_ABSTRACT = r"\b in ([A-Z][A-Za-z.\- ]{2,40})(?:, ([A-Z][A-Za-z.\- ]{2,40}))?\b"

# Text patterns of listing and detail pages.
DESTINATION_SECTION = r"(?is)Top destinations(.*?)Top countries to visit"
DESTINATION_LINK = r'(?is)<a[^>]+href="(/[^"]+-l\d+/)"[^>]*>.*?<div[^>]*class="title"[^>]*>(.*?)</div>'
CARD_BY_TEST_ID = r'(?is)(<a[^>]*data-test-id="vertical-activity-card-link"[^>]*>.*?</a>)'
CARD_BY_CLASS = r'(?is)(<a[^>]*class="[^"]*vertical-activity-card__container[^"]*"[^>]*>.*?</a>)'
CARD_HREF = r'(?i)href="([^"]+)"'
CARD_TITLE = r"(?is)<h3[^>]*>(.*?)</h3>"
CARD_RATING = r"(?is)c-activity-rating__rating[^>]*>([\d.,]+)</"
CARD_REVIEWS = r"(?is)c-activity-rating__label[^>]*>\(?([\d,]+)\)?"
PRICE_BLOCK = r'(?is)(<div[^>]*class="[^"]*activity-price[^"]*"[^>]*>.*?</div>)'
PRICE_PIECE = r"(?is)>([^<>]*?(?:€|\$)\s*\d+[^\d<>]*)<|>(From|per person|per group up to \d+)<"
DETAIL_TITLE = r"(?s)<h1[^>]*>(.*?)</h1>"
LD_BLOCK = r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'
LD_WANTED = r'"@type"\s*:\s*"(Product|TouristAttraction)"'
LD_TYPE = r'"@type"\s*:\s*"([^"]+)"'
LD_NAME = r'"name"\s*:\s*"([^"]+)"'
LD_DESCRIPTION = r'"description"\s*:\s*"([^"]+)"'
LD_RATING = r'"ratingValue"\s*:\s*([0-9.]+)'
LD_REVIEWS = r'"reviewCount"\s*:\s*([0-9]+)'
LD_PRICE = r'"price"\s*:\s*"([^"]+)"'
LD_CURRENCY = r'"priceCurrency"\s*:\s*"([^"]+)"'
HIGHLIGHTS = r'(?is)<div[^>]*id="highlights-point"[^>]*>.*?<ul[^>]*>(.*?)</ul>'
LIST_ITEM = r"(?is)<li[^>]*>(.*?)</li>"
REVIEW = r'(?is)<p[^>]*class="review-highlight-card__text--v2\s+review-highlight-card__text"[^>]*>.*?<span[^>]*>(.*?)</span>'
TAG = r"<[^>]+>"
FRAGMENT_MARKS = ["<!--[-->", "<!--]-->"]
