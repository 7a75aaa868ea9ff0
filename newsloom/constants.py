"""Fixed values shared by the operators.

Everything here is a value that results depend on (word lists, character sets,
column layouts). They are stated once, plainly, and imported elsewhere.
"""

# --- fixed values: texts that mean "no value" -------------------------------
SENTINELS = ["", " ", "-", "none", "None", "null", "NULL", "undefined", "Undefined", "N/A"]

# --- fixed values: news categories, position in the list is the code --------
CATEGORIES = [
    "business",
    "entertainment",
    "general",
    "health",
    "science",
    "sports",
    "technology",
    "politics",
]
DEFAULT_CATEGORY = "general"
CATEGORY_TYPOS = {"poiltics": "politics", "poltics": "politics", "politic": "politics"}
RARE_BELOW = 5

# --- fixed values: corpus label harmonisation --------------------------------
CORPUS_LABELS = {"sports": "sport", "technology": "tech"}

# --- fixed values: characters that count as blank in Unicode text ------------
# Written as an explicit class so that every regex engine agrees on it.
BLANK = (
    r"\t\n\x0B\f\r \x{1C}-\x{1F}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)

# the same blanks, one by one
BLANK_CHARACTERS = "".join(
    chr(c) for c in [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                     0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
)

# --- fixed values: symbol groups of the text cleaner --------------------------
SYMBOL_NOISE = "•·●►▶▷☛→←↔⇨⇦■□★☆◆◇※©®™∞¶§"
QUOTES = "“”‘’‛❛❜‚„‹›«»"
DASHES = r"\x{2010}-\x{2012}\x{2013}\x{2014}\x{2015}"
THAI = r"\x{0E01}-\x{0E59}"

# --- fixed values: audit and housekeeping columns -----------------------------
AUDIT_COLUMNS = ["createdate", "usercreate", "updatedate", "userupdate", "sf_id"]
SYSTEM_USER = "system"

# --- fixed values: bit layout and epoch used when no config table is given ----
ID_BITS = {"timestamp": 41, "datacenter": 5, "worker": 5, "sequence": 12}
ID_EPOCH_MS = 1704067200000  # 2024-01-01T00:00:00Z

# --- fixed values: the combined layer -----------------------------------------
COMBINED_COLUMNS = [
    ("sf_id", "string"),
    ("source_system", "string"),
    ("source_name", "string"),
    ("article_id", "string"),
    ("author", "string"),
    ("title", "string"),
    ("description", "string"),
    ("url", "string"),
    ("image_url", "string"),
    ("category", "string"),
    ("language", "string"),
    ("region", "string"),
    ("content", "string"),
    ("published_at", "timestamp"),
    ("createdate", "timestamp"),
    ("updatedate", "timestamp"),
    ("batch_id", "string"),
    ("layer", "string"),
    ("usercreate", "string"),
    ("userupdate", "string"),
    ("activedata", "boolean"),
]

# Per source: combined column -> source column. A column that is not listed has
# the same name in the source; ``None`` means the source has no such column.
COMBINED_MAPPING = {
    "currentsapi": {"source_name": "source_news", "article_id": "id", "content": None},
    "mediastack": {"source_name": "source_news", "article_id": None, "content": None},
    "newsapi": {"source_name": "source_news", "article_id": "source_id"},
    "staging": {
        "sf_id": None,
        "source_system": None,
        "source_name": "source",
        "article_id": "id",
        "title": "titlenews",
        "image_url": "imageurl",
        "region": None,
        "content": None,
        "published_at": "publishedtime",
        "batch_id": None,
        "layer": "='silver'",
    },
}

GOLD_COLUMNS = [
    "sf_id",
    "url",
    "source_system",
    "category",
    "title_clean",
    "description_clean",
    "published_at",
    "embedding",
    "category_encode",
]

# --- fixed values: the encoder width used when no model is plugged in ---------
EMBEDDING_DIM = 64
