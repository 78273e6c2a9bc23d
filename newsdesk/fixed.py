"""Values that must equal the reference's for the results to match.

Everything here is a stated rule of the reference, kept as plain text in
its natural order; the modules import it from here.
"""

# ---- fixed values -----------------------------------------------------------

# URL cleaning (functions.urls.clean_url)
# Query keys that are always dropped (the empty key included).
BAD_KEYS = [
    "", "_r", "action_object_map", "action_ref_map", "action_type_map", "amp",
    "asrc", "beta", "CMP", "cmp", "cmpid", "comm_ref", "cpage", "dlvrit",
    "ex_cid", "f", "feedName", "feedType", "ft", "gplus", "kc", "lifehealth",
    "logvisit", "mbid", "ncid", "npu", "op", "rpc", "s_cid", "sc", "source",
    "subj", "tag", "tc", "urw", "virtualBrandChannel",
]
# Values that drop their key wherever they appear.
BAD_VALUES = ["rss"]
# Key prefixes that are dropped.
BAD_KEY_PREFIXES = ["utm_", "fb", "atc"]
# Substring of a key that drops it.
BAD_KEY_SUBSTRING = ".99"
# (key, first value) pairs that are dropped.
BAD_PAIRS = [("ref", "25"), ("ana", "RSS"), ("s", "article_search"), ("attr", "all")]

# Page checks (operators.articles.page_validate): exact content types that
# are refused, and the page size limit in bytes (equal length is refused).
BAD_CONTENT_TYPES = ["audio/mpeg"]
SIZE_LIMIT = 2097152

# Feed polling (operators.feeds): feeds handed out per run; poll statuses
# after which entries are not read (a missing status counts as 500); the
# re-poll delay after a clean poll.
DUE_FEEDS_LIMIT = 25
SKIP_STATUSES = [304, 410, 500]
MISSING_STATUS = 500
REPOLL = "INTERVAL 1 HOUR"

# Work queue (operators.work.queue_depth): waiting rows above which feeds
# are not handed out.
QUEUE_THRESHOLD = 100

# Newswire (operators.wire): a body under this many bytes is empty; the
# origins of newswire articles (plain and licensed runs).
WIRE_BODY_MIN_BYTES = 10
WIRE_ORIGINS = ["webnews", "lexisnexis"]
RSS_ORIGIN = "rss"

# Catalogue pages (operators.catalog): default and largest page size.
PAGE_LIMIT = 20
PAGE_LIMIT_MAX = 10000

# Pub export (sinks.export_pubs_csv): header and date format.
EXPORT_HEADER = ["ID", "Pub Name", "Homepage", "Added"]
EXPORT_DATE_FORMAT = "MM/dd/yyyy"

# Category aliases (operators.categories): 15 aliases, 123 categories.
CATEGORY_ALIASES = [
    ("Agricultural", ["Agricultural Products"]),
    ("Arts", ["Arts", "Charity", "Film", "Music", "Photography", "Society", "Theater"]),
    ("Automotive", ["Automobiles Components"]),
    ("Business", ["Business", "Company Site", "Human Resources", "Industrials", "Insurance",
                  "International Agency", "Management", "Management Consulting", "Marketing",
                  "Media", "Media Advertising", "Online Marketing", "Organisations",
                  "Professional"]),
    ("Consumer", ["Beverages", "Consumables", "Consumer", "Extreme", "Fashion", "Food Products",
                  "Gossip", "Home", "Hotels Restaurants Leisure", "Lifestyle", "Literature",
                  "Offbeat", "Real Estate", "Recipes", "Recreation", "Religion", "Restaurants",
                  "Retailing", "Satire", "Television", "Textiles Apparel", "Tobacco",
                  "Travel Tourism", "Winter"]),
    ("Education", ["Education"]),
    ("Engineering and Science", ["Construction Engineering", "Chemicals", "Energy", "Environment",
                                 "Geographic", "Materials", "Metals Mining", "Oil Gas",
                                 "Paper Forest Products", "Transportation", "Utilities", "Science"]),
    ("Financial", ["Accounting", "Banking", "Financials"]),
    ("Government", ["Aerospace Defense", "Politics", "Government"]),
    ("Healthcare", ["Health", "Health Care", "Health Care Equipment Services", "Healthcare",
                    "Medical", "Pharmaceuticals"]),
    ("Information Technology", ["Biotechnology", "Computers", "Electronic Equipment",
                                "Imaging Equipment", "Software", "Telecommunication Services",
                                "Information Technology", "Internet"]),
    ("Legal", ["Law"]),
    ("Logistics", ["Air Freight Logistics", "Containers Packaging"]),
    ("News", ["Global", "Local", "Miscellaneous", "National", "News", "Regional", "Standard",
              "Wires"]),
    ("Sports", ["American Football", "Athletics", "Badminton", "Baseball", "Basketball", "Boxing",
                "Casinos Gaming", "Cricket", "Cycling", "Field Hockey", "Fishing", "Games", "Golf",
                "Gymnastics", "Handball", "Horse Racing", "Ice Hockey", "Martial Arts",
                "Motor Racing", "Olympics", "Rowing", "Rugby", "Snooker", "Soccer", "Sports",
                "Squash", "Swimming", "Table Tennis", "Tennis", "Volleyball", "Wrestling",
                "Yachting"]),
]

# -----------------------------------------------------------------------------
