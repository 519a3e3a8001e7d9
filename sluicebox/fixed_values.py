"""Fixed values the results depend on: patterns, word lists, thresholds, labels."""

# --- patterns that mark a cell as dirty (Java regex; (?d) makes "." and "$" see only \n as a line end)
TEXT_DIRTY = r"\[[^\]]*\]|[†‡*]|[\x00-\x1F\x7F]"
MONEY_CHARACTERS = "$€£₹(),"
MONEY_SUFFIX = r"(?d)\d[KMBkmb]$"
YEAR = r"(19\d{2}|20\d{2})"
YEAR_RANGE = r"(?d)(19\d{2}|20\d{2}).*(19\d{2}|20\d{2})"

# Any cell that fits TEXT_DIRTY holds "[", "*" or one of these characters; a cheaper test to make first.
TEXT_DIRTY_CHARACTERS = r"[^\x20-\x7E]"

# --- patterns that describe a clean cell
ID_VALUE = r"^(?=.*[A-Za-z])(?=.*\d)[A-Za-z0-9\-_]{8,}$"
HAS_LETTER = r"[A-Za-z]"
PLAIN_NUMBER = r"^\d+(\.\d+)?$"
NUMBER = r"^\s*+[+-]?+(?:(?:\d++(?:\.\d*+)?+|\.\d++)(?:[eE][+-]?+\d++)?+|(?i:inf(?:inity)?+))\s*+$"
WHOLE_NUMBER = r"^\s*+[+-]?+\d++\s*+$"
DELIMITER = r"[;/,:]"

# --- thresholds on measured ratios
TEXT_THRESHOLD = 0.6
YEAR_THRESHOLD = 0.6
MONEY_THRESHOLD = 0.1
DATE_THRESHOLD = 0.6
ID_VALUE_THRESHOLD = 0.9
UNIQUE_THRESHOLD = 0.95
LETTER_THRESHOLD = 0.6
PLAIN_NUMBER_LIMIT = 0.2
YEAR_VALUE_THRESHOLD = 0.8
YEAR_LOW, YEAR_HIGH = 1800, 2200
NUMERIC_LIKE_THRESHOLD = 0.6
TYPE_THRESHOLD = 0.95
INTEGRAL_THRESHOLD = 0.99
CATEGORY_LIMIT = 0.1
SPARSE_LIMIT = 0.8
KEY_FILLED_LIMIT = 0.95
KEY_UNIQUE_LOW, KEY_UNIQUE_HIGH = 0.3, 0.98
MAX_BUSINESS_KEYS = 3
REMOVAL_LIMIT = 0.3
ROW_DROP_LIMIT = 0.3
NULL_RATIO_LIMIT = 0.3
STRUCTURAL_SUFFIXES = ("_end",)
BIN_UNIQUE_LIMIT = 0.2
BIN_COUNT = 4
IQR_FACTOR = 1.5

# --- words
BOOLEAN_WORDS = ("0", "1", "true", "false", "yes", "no")
TRUE_WORDS = ("1", "true", "yes")
ID_NAMES = ("id", "uuid", "guid")
MISSING_WORDS = (
    "", " ", "  ", "   ", "\t", "\n",
    "nan", "NaN", "NAN", "null", "NULL", "none", "None", "NONE",
    "-", "--", "—", "<NA>",
)
CSV_MISSING_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)
CSV_BOOLEANS = ("True", "TRUE", "true", "False", "FALSE", "false")
MOJIBAKE = (("â€ ", ""), ("â€¡", ""), ("Ã©", "é"))
SUFFIX_SCALE = (("K", 1e3), ("M", 1e6), ("B", 1e9))
SYSTEM_DATABASES = ("mysql", "information_schema", "performance_schema", "sys")

# --- one row per date format: name, shape the cell must have, Spark pattern
DATE_FORMATS = (
    ("iso_date", r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$", "yyyy-M-d"),
    ("iso_minute", r"^\s*\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}\s*$", "yyyy-M-d H:mm"),
    ("iso_second", r"^\s*\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{2}:\d{2}(\.\d{1,6})?\s*$", "yyyy-M-d H:mm:ss[.SSSSSS]"),
    ("iso_t", r"^\s*\d{4}-\d{1,2}-\d{1,2}T\d{1,2}:\d{2}:\d{2}(\.\d{1,6})?\s*$", "yyyy-M-d'T'H:mm:ss[.SSSSSS]"),
    ("slash_ymd", r"^\s*\d{4}/\d{1,2}/\d{1,2}\s*$", "yyyy/M/d"),
    ("slash_mdy", r"^\s*\d{1,2}/\d{1,2}/\d{4}\s*$", "M/d/yyyy"),
    ("slash_dmy", r"^\s*\d{1,2}/\d{1,2}/\d{4}\s*$", "d/M/yyyy"),
    ("slash_mdy_minute", r"^\s*\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{2}\s*$", "M/d/yyyy H:mm"),
    ("dash_mdy", r"^\s*\d{1,2}-\d{1,2}-\d{4}\s*$", "M-d-yyyy"),
    ("dash_dmy", r"^\s*\d{1,2}-\d{1,2}-\d{4}\s*$", "d-M-yyyy"),
    ("month_name", r"^\s*[A-Za-z]{3} \d{1,2}, \d{4}\s*$", "MMM d, yyyy"),
    ("month_full", r"^\s*[A-Za-z]{4,9} \d{1,2}, \d{4}\s*$", "MMMM d, yyyy"),
    ("day_month_name", r"^\s*\d{1,2} [A-Za-z]{3} \d{4}\s*$", "d MMM yyyy"),
)

# --- texts of the transform plan
REASONS = {
    "lowercase": "Text column detected",
    "strip": "Leading/trailing spaces possible",
    "normalize_delimiters": "Multiple delimiters detected (; / : ,)",
    "split_multi_values": "Multi-valued text detected (skills/tags)",
    "cast_year": "Year column should remain integer",
    "cast": "Numeric column",
    "bins": "High cardinality numeric column",
    "split_year": "Year range detected (e.g. 2018-2020)",
}
