"""Values fixed by the business rules: they must match exactly for results to match."""

# fixed values: the 50 state codes that count as valid, in natural order
US_STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
]

# fixed values: accepted email form
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"

# fixed values: band limits and labels
TENURE_DAYS = [(90, "New"), (365, "Established"), (730, "Loyal")]
TENURE_BEYOND = "VIP"
RECENCY_DAYS = [(30, "Active"), (90, "Recent"), (180, "Lapsed")]
RECENCY_BEYOND = "Dormant"
AMOUNT_BUCKETS = [(25, "Small (<$25)"), (100, "Medium ($25-$100)"), (500, "Large ($100-$500)")]
AMOUNT_BEYOND = "XLarge ($500+)"
DAY_PARTS = [(6, 11, "Morning"), (12, 17, "Afternoon"), (18, 21, "Evening")]
DAY_PART_ELSE = "Night"
REVENUE_TIERS = [(100000, "Platinum"), (50000, "Gold"), (10000, "Silver")]
PRICE_TIERS = [(500, "Premium"), (100, "Mid-Range"), (25, "Value")]
PRICE_BEYOND = "Budget"
RECENCY_SCORES = [(30, 5), (60, 4), (90, 3), (180, 2)]
FREQUENCY_SCORES = [(20, 5), (10, 4), (5, 3), (2, 2)]
MONETARY_SCORES = [(5000, 5), (2000, 4), (500, 3), (100, 2)]
VALUE_SEGMENTS = [(13, "Champions"), (10, "Loyal"), (7, "Potential"), (4, "At Risk")]
VALUE_ELSE = "Lost"
STORE_TIERS = [(50, "Top Performer"), (200, "Above Average"), (350, "Average")]
STORE_TIER_ELSE = "Below Average"

# fixed values: table and column tags (schema, table, column, tag, value)
TAGS = [
    ("gold", "customer_360", None, "domain", "customer"),
    ("gold", "customer_360", None, "sensitivity", "high"),
    ("gold", "customer_360", None, "pii", "true"),
    ("gold", "daily_sales_summary", None, "domain", "sales"),
    ("gold", "daily_sales_summary", None, "sensitivity", "medium"),
    ("gold", "daily_sales_summary", None, "pii", "false"),
    ("gold", "product_performance", None, "domain", "product"),
    ("gold", "product_performance", None, "sensitivity", "low"),
    ("gold", "product_performance", None, "pii", "false"),
    ("gold", "store_analytics", None, "domain", "store"),
    ("gold", "store_analytics", None, "sensitivity", "medium"),
    ("gold", "store_analytics", None, "pii", "false"),
    ("silver", "customers", "email", "pii", "true"),
    ("silver", "customers", "email", "pii_type", "email"),
    ("silver", "customers", "phone", "pii", "true"),
    ("silver", "customers", "phone", "pii_type", "phone"),
    ("silver", "customers", "first_name", "pii", "true"),
    ("silver", "customers", "first_name", "pii_type", "name"),
    ("silver", "customers", "last_name", "pii", "true"),
    ("silver", "customers", "last_name", "pii_type", "name"),
]

# fixed values: hours a row is kept per layer
RETENTION_HOURS = {"bronze": 168, "silver": 336, "gold": 720}
