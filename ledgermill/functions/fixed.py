"""Thresholds, names and lists that decide results."""

# amount bands of a single transaction
HIGH_AMOUNT_OVER = 5000
MEDIUM_AMOUNT_OVER = 1000

# customer tiers by total spend
PREMIUM_OVER = 50000
STANDARD_OVER = 15000

# segments by total spend, with and without a mortgage
MORTGAGE_HIGH_OVER = 30000
MORTGAGE_STANDARD_OVER = 10000
NO_MORTGAGE_HIGH_OVER = 20000
NO_MORTGAGE_STANDARD_OVER = 5000

# CDC amount above which an event is flagged
HIGH_VALUE_OVER = 10000

# the one role that sees personal columns unmasked, and what the others see
STEWARD_ROLE = "DATA_STEWARD"
HIDDEN_NAME = "***"
HIDDEN_PHONE_PREFIX = "***-***-"

# loan types with a shorter name
LOAN_TYPE_NAMES = {
    "FSA/RHS-guaranteed": "FSA_RHS",
    "FHA-insured": "FHA",
    "VA-guaranteed": "VA",
}

# transaction type, expected share in percent, lowest and highest usual amount
TYPE_RULES = [
    ("leisure_payment", 40, 50, 500),
    ("subscription_fee", 15, 10, 100),
    ("travel_expense", 10, 200, 2000),
    ("shopping", 10, 30, 800),
    ("dining", 7, 20, 200),
    ("entertainment", 5, 25, 300),
    ("fitness_wellness", 5, 50, 500),
    ("education", 3, 100, 1000),
    ("luxury_purchase", 3, 500, 5000),
    ("miscellaneous", 2, 20, 300),
]
ANOMALY_LOW = 25000
ANOMALY_HIGH = 75000

# rows expected per day: half to twice the target, seven tenths of that at weekends
DAILY_TARGET = 548
WEEKEND_FACTOR = 0.7

# customers up to this id hold the mortgage numbered id - offset; later ones hold none
LAST_CUSTOMER_WITH_LOAN = 5800
LOAN_ID_OFFSET = 1000

# dashboard
PERIODS = {"Last 7 Days": 7, "Last 30 Days": 30, "Last 90 Days": 90, "Last Year": 365}
DEFAULT_TYPES = ["leisure", "lifestyle", "business"]
NEWEST_ROWS = 10000
RECENT_ROWS = 20
PREVIEW_ROWS = 10
