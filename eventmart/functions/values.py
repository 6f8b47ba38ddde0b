"""Fixed values that results depend on, stated as text."""

UNKNOWN = "UNKNOWN"
EPOCH_DATE = "1970-01-01"
EPOCH_TIME = "1970-01-01 00:00:00"
PURCHASE = "purchase"
PRODUCT_LINES = ("third", "body", "medical", "fire")
TAX_RATE = "0.09"
NET_BUCKET_DIGITS = -5
RETENTION_MONTHS = 18
LAG_LIMIT_SECONDS = 600
