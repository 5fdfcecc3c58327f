"""Fixed values that the results depend on.

These values must equal the behaviour being reproduced; they are listed here
together, in their natural order, as plain text.
"""

# --- fixed values -----------------------------------------------------------
# Detection rules.
HIGH_VALUE_THRESHOLD = 5000.0          # strict ``amount > threshold``
REASON_HIGH_VALUE = "HIGH_VALUE_TRANSACTION"
REASON_TRAVEL = "IMPOSSIBLE_TRAVEL"
WATERMARK_DELAY = "15 minutes"
WINDOW_MINUTES = 10                    # length of the sliding window
WINDOW_LENGTH = f"{WINDOW_MINUTES} minutes"
WINDOW_SLIDE = "1 minute"
TRAVEL_GAP_SECONDS = 600               # "different countries within 10 minutes" (inclusive)

# Batch layer.
RECONCILIATION_LOOKBACK_HOURS = 6
REPORT_LOOKBACK_HOURS = 24             # report default; queries() use 168

# Fraud-table column limits (NOT NULL on all six business columns).
MAX_LEN_USER_ID = 50
MAX_LEN_MERCHANT_CATEGORY = 100
MAX_LEN_LOCATION = 10
MAX_LEN_FRAUD_REASON = 255

# Report layer.
HISTOGRAM_BINS = 40
DENSITY_GRID_POINTS = 200
TOP_CATEGORIES = 10
REPORT_TABLE_ROWS = 12

# Country codes of the transaction generator, in its order.
COUNTRIES = ["US", "UK", "CA", "DE", "FR", "JP", "AU", "IN", "BR", "MX"]
# --- end of fixed values ----------------------------------------------------

MICROS_PER_MINUTE = 60_000_000
MICROS_PER_SECOND = 1_000_000
