"""Bands, day counts, ladders, grids and names that results depend on."""

# --- fixed values ---------------------------------------------------------------------------------------------------

# family, lowest and highest list price
PRICE_BANDS = [
    ("BREAD_BAKERY", 2.40, 4.00),
    ("DAIRY", 4.00, 7.00),
    ("DELI", 5.00, 12.00),
    ("EGGS", 3.00, 5.50),
    ("MEATS", 10.00, 20.00),
    ("POULTRY", 8.00, 15.00),
    ("PREPARED_FOODS", 6.00, 15.00),
    ("PRODUCE", 2.50, 7.00),
    ("SEAFOOD", 15.00, 25.00),
]
BAND_CENTRE = 0.50
BAND_JITTER = 0.10
HASH_SPREAD = 1_000_000

# shelf life in days by family, and for every other family
SHELF_LIFE_DAYS = {
    "BREAD_BAKERY": 3,
    "DAIRY": 10,
    "DELI": 5,
    "EGGS": 21,
    "MEATS": 7,
    "POULTRY": 5,
    "PREPARED_FOODS": 3,
    "PRODUCE": 5,
    "SEAFOOD": 5,
}
SHELF_LIFE_DEFAULT = 14

# markdown by days left: first step whose minimum is reached, else clearance
MARKDOWN_STEPS = [(6, 0.00), (4, 0.10), (3, 0.20), (2, 0.30), (1, 0.40)]
MARKDOWN_CLEARANCE = 0.50

# candidate discounts of the policy sweep
DISCOUNT_GRID = [0.0, 0.1, 0.2, 0.3, 0.4, 0.5]

# expiry buckets by largest day count, in display order
EXPIRY_BUCKETS = [(1, "0-1d"), (3, "2-3d"), (5, "4-5d")]
EXPIRY_BUCKET_LAST = "6d+"

# accepted spellings of a boolean, lower case
TRUE_WORDS = ["true", "1", "yes"]
FALSE_WORDS = ["false", "0", "no"]

# holiday rows that count as a day off
DAY_OFF_TYPES = ["Transfer", "Bridge", "Additional"]
HOLIDAY_TYPE = "Holiday"
NATIONAL_LOCALE = "National"

UNITS_MIN, UNITS_MAX = 0.0, 200.0
MIN_HISTORY_ROWS = 28
SPLIT_MAX_DATE = "2017-08-15"
SPLIT_VALID_DAYS = 28
SPLIT_TEST_DAYS = 14
NEAR_EXPIRY_DAYS = 2
UNKNOWN_CATEGORY = "__UNK__"

# delivered file name -> logical table; every other file goes to "misc"
FILE_ROUTES = {
    "train.csv": "sales",
    "test.csv": "sales",
    "transactions.csv": "transactions",
    "oil.csv": "oil_prices",
    "holidays_events.csv": "holidays",
    "stores.csv": "stores",
    "sample_submission.csv": "_docs",
}
FILE_ROUTE_DEFAULT = "misc"

# model columns
LABEL = "unit_sales"
CATEGORICAL_FEATURES = ["family", "class", "store_nbr", "cluster"]
NUMERIC_FEATURES = [
    "effective_price",
    "discount_pct",
    "time_to_expiry",
    "base_price",
    "lag1_log_sales",
    "lag7_log_sales",
    "lag14_log_sales",
    "lag28_log_sales",
    "rm7_log_sales",
    "rm28_log_sales",
    "promo_in_last_7d",
    "dow",
    "month",
    "year",
]

# --- end of fixed values --------------------------------------------------------------------------------------------

KEYS = ["date", "store_nbr", "item_nbr"]
SERIES = ["store_nbr", "item_nbr"]
