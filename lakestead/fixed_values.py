"""Constants the results depend on, kept in one place."""

# Order states accepted by the order rule.
ORDER_STATUSES = ("pending", "processing", "shipped", "delivered", "canceled")

# Penalty and note of every record rule, in the order the notes are reported.
CUSTOMER_PENALTIES = {
    "customer_id": ("0.30", "Missing customer_id"),
    "customer_unique_id": ("0.20", "Missing customer_unique_id"),
    "zip": ("0.15", "Invalid zip code"),
    "city": ("0.20", "Missing city"),
    "state": ("0.15", "Invalid state code"),
}
ORDER_PENALTIES = {
    "order_id": ("0.30", "Missing order_id"),
    "customer_id": ("0.30", "Missing customer_id"),
    "status": ("0.20", "Invalid order_status: "),
    "purchase": ("0.20", "Missing purchase timestamp"),
}
PRODUCT_PENALTIES = {
    "product_id": ("0.30", "Missing product_id"),
    "category": ("0.20", "Missing category name"),
}
SELLER_PENALTIES = {
    "seller_id": ("0.30", "Missing seller_id"),
    "zip": ("0.20", "Invalid zip code"),
    "city": ("0.20", "Missing city"),
    "state": ("0.15", "Invalid state code"),
}
GEOLOCATION_PENALTIES = {
    "zip": ("0.30", "Invalid zip code"),
    "position": ("0.30", "Missing latitude or longitude"),
}
NOTE_SEPARATOR = "; "
VALID_ABOVE = "0.50"
MIN_ZIP_CHARS = 5
STATE_CHARS = 2

# What Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Text a null turns into in compat mode.
NULL_AS_TEXT = "None"

# Declared column widths.
TEXT_WIDTHS = {
    "customer_id": 255,
    "customer_unique_id": 255,
    "customer_zip_code_prefix": 10,
    "customer_city": 255,
    "customer_state": 2,
    "seller_id": 255,
    "seller_zip_code_prefix": 10,
    "seller_city": 255,
    "seller_state": 2,
    "order_id": 255,
    "order_status": 50,
    "product_id": 255,
    "location_key": 50,
    "state_code": 2,
    "city_name": 255,
}

# Default calendar of the date dimension.
CALENDAR_START = "2015-01-01"
CALENDAR_END = "2025-12-31"

# Change reasons of the seller history.
REASON_INITIAL = "Initial load"
REASON_CLOSED = "Location changed"
REASON_UPDATED = "Location updated"
ETL_USER = "ETL"
RAW_USER = "system"

# Lifetime-value segments; each holds values below its bound, the last takes the rest.
SEGMENT_BOUNDS = (("Bronze", 1000), ("Silver", 5000), ("Gold", 20000))
TOP_SEGMENT = "Platinum"

# Report defaults.
REPORT_MIN_YEAR = 2017
REPORT_MIN_ORDERS = 50
REGION_REPORT_ROWS = 20
PRODUCT_REPORT_ROWS = 15
PRODUCT_DASHBOARD_ROWS = 20
CHART_TOP = 10
PIE_TOP = 5
PIE_REST = "Rest of Portfolio"

# Labels of the count reports.
LABEL_DATES = "Dates"
LABEL_CUSTOMERS = "Customers"
LABEL_PRODUCTS = "Products"
LABEL_SELLERS_CURRENT = "Sellers (Current SCD)"
LABEL_SELLER_HISTORY = "Seller History Records"
LABEL_LOCATIONS = "Locations"
LABEL_ORDERS = "Orders (Fact)"
LABEL_ORDER_VALUE = "Total Order Value"
LINEAGE_CURATED = ("Orders Refined", "Customers Refined", "Order Items Refined", "Sellers Refined")
LINEAGE_WAREHOUSE = (
    "Fact Orders",
    "Dimension Customers",
    "Dimension Products",
    "Dimension Sellers (Current)",
    "Dimension Locations",
)
