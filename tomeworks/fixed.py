"""Fixed values.

Everything in this file is data that other systems depend on: source names, URL
shapes, rights codes, column orders and text patterns.  They are stated once, as
plain text, and never computed.
"""

SCHEMA_VERSION = 1

# --- fixed values: listing source -------------------------------------------
LISTING_SOURCE = "gutenberg"
LISTING_ID_KEY = "gutenberg_id"
LISTING_VERSION = "gutenbergapi.com/v1"
LISTING_PAGE_URL = "https://www.gutenberg.org/ebooks/"
LISTING_TEXT_SUFFIX = ".txt.utf-8"
LISTING_LICENSE = "Public domain in the USA"
LISTING_RIGHTS = (
    "Project Gutenberg collection-level default; not verified per record "
    "(source API exposes no copyright field)"
)

# --- fixed values: bulk volume source ---------------------------------------
VOLUME_SOURCE = "hathitrust"
VOLUME_PAGE_URL = "https://babel.hathitrust.org/cgi/pt?id="
VOLUME_RECORD_URL = "https://catalog.hathitrust.org/Record/"
VOLUME_COLUMNS = (
    "htid", "access", "rights", "ht_bib_key", "description", "source",
    "source_bib_num", "oclc_num", "isbn", "issn", "lccn", "title", "imprint",
    "rights_reason_code", "rights_timestamp", "us_gov_doc_flag", "rights_date_used",
    "pub_place", "lang", "bib_fmt", "collection_code", "content_provider_code",
    "responsible_entity_code", "digitization_agent_code", "access_profile_code", "author",
)
PUBLIC_DOMAIN_CODES = ("pd", "pdus", "pd-pvt")

# --- fixed values: text ------------------------------------------------------
# Preference order of text origins, best first.
TEXT_ORIGINS = ("summary", "description", "intro", "first_chars", "none")
# Closing line of the front matter of a plain-text work; everything up to and
# including it is dropped.  Matched case-insensitively and across line ends.
FRONT_MATTER_MARKER = r"\*\*\*\s*START OF TH(?:E|IS) PROJECT GUTENBERG EBOOK.*?\*\*\*"
MARKER_WINDOW = 20000
PREVIEW_CHARS = 4000
DISPLAY_CHARS = 40000
# Every code point that counts as white space at either end of a text.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NUMBER_PATTERN = r"-?\d+(?:\.\d+)?"

# --- fixed values: columns that a content hash leaves out ----------------------
NOT_HASHED = (
    "download_count", "ingested_at", "content_hash", "provider_version", "schema_version",
    "searchable_text", "text_source", "text_char_count",
)

# --- fixed values: run defaults ----------------------------------------------
# A run takes all there is unless its caller sets limits.
DEFAULT_MAX_ROWS = None
DEFAULT_BUDGET = None
DEFAULT_TEXT_CAP = None
DEFAULT_ROWS_PER_FILE = 5000
DEFAULT_COMPRESSION = "zstd"
