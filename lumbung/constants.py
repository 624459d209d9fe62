"""Fixed values.

Names, labels, thresholds, patterns and formats below are part of the data
contract: results are only right when they are spelled exactly like this.
"""

# Layout of the landing area.
CUSTOMER_EXPORT = "customers"
PRODUCT_EXPORT = "products"
ORDER_COLLECTION = "orders"
CUSTOMER_FIELDS = ("customer_id", "full_name", "email", "city", "signup_date", "segment", "phone", "gender")
PRODUCT_FIELDS = (
    "product_id", "sku", "product_name", "category", "price", "cost", "stock_qty", "weight_gram", "is_active",
)
ORDER_FIELDS = ("order_id", "customer_id", "order_date", "status", "payment_method", "channel", "total_amount", "items")

# Columns of documents that hold one part of an order's lines; a document without them holds all.
PART_FIELDS = {"part": "int", "lines_before": "long", "product_before": "string"}

# E-mail format; \z is the end of the text, also when a newline closes it.
EMAIL_PATTERN = r"(?i)^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\z"

# Order life cycle.
STATUS_COMPLETED = "completed"
STATUS_CANCELLED = "cancelled"
STATUS_MISSING = "unknown"
ORDER_STATUSES = ("pending", "processing", "completed", "cancelled")
PAYMENT_METHODS = ("e-wallet", "transfer bank", "kartu kredit", "cod", "paylater")

# Customer tiers by lifetime net spend, highest first.
TIER_PLATINUM_FROM = 50_000_000
TIER_GOLD_FROM = 20_000_000
TIER_SILVER_FROM = 5_000_000
TIER_PLATINUM = "Platinum"
TIER_GOLD = "Gold"
TIER_SILVER = "Silver"
TIER_BRONZE = "Bronze"
TIER_NONE = "No Purchases"

# The member that stands for every buyer without a customer record.
UNKNOWN_ID = "UNKNOWN"
UNKNOWN_NAME = "Guest / Unregistered Customer"
UNKNOWN_CITY = "Unknown"
UNKNOWN_SIGNUP = "2020-01-01"
UNKNOWN_SEGMENT = "guest"
UNKNOWN_GENDER = "UNKNOWN"
UNKNOWN_TIER = "Guest / Unregistered"

# Stock labels.
STOCK_LOW_BELOW = 20
STOCK_OUT = "Out of Stock"
STOCK_LOW = "Low Stock"
STOCK_HEALTHY = "Healthy"

# Text that stands for a missing category inside the daily key.
NO_CATEGORY = "None"

# Display names of the sales channels; others keep their own name.
CHANNEL_LABELS = {"mobile_app": "Mobile App", "marketplace": "Marketplace", "website": "Website"}

# Names of the two sides of the guest audit in the export.
REGISTERED_LABEL = "Registered CRM Customers"
GUEST_LABEL = "Guest Checkout (Kimball 'UNKNOWN' Preserved)"

# Filter value that selects everything.
ALL = "ALL"

# First order date that counts as plausible.
EARLIEST_ORDER_DATE = "2020-01-01"
