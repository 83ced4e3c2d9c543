"""Labels, limits and weights that results depend on.

Operators take every one of them as an argument; these are the defaults.
"""

# Row status of a standardized observation.
VALID = "VALID"
INVALID_PRICE = "INVALID_PRICE"
MISSING_TITLE = "MISSING_TITLE"
INVALID_RATING = "INVALID_RATING"

# Bounds of a valid rating and of an unsuspicious price.
RATING_BOUNDS = (0, 5)
PRICE_BOUNDS = (100, 100000)

# What a consistent load holds, and the score of a load that does not.
EXPECTED_PRODUCTS = 11
EXPECTED_SOURCES = 1
INCONSISTENT_SCORE = 50.0

# Share of each pillar in the overall quality score.
PILLAR_WEIGHTS = {
    "completeness": 0.25,
    "validity": 0.25,
    "uniqueness": 0.20,
    "consistency": 0.15,
    "accuracy": 0.10,
    "timeliness": 0.05,
}

SOURCE_SYSTEM = "amazon_in_rainforest_api"

# Direction of a price against the price before it.
FIRST_RECORD = "FIRST_RECORD"
UP = "UP"
DOWN = "DOWN"
STABLE = "STABLE"

# Review velocity: more than so many reviews gained; then standing still; then the rest.
REVIEW_VELOCITY = (("HIGH", 50), ("MEDIUM", 10), ("LOW", 0))
STAGNANT = "STAGNANT"
DECLINING = "DECLINING"

# Stock text of a product that can be bought, and the opportunity of one that cannot.
IN_STOCK = "in_stock"
DEMAND_REVIEWS = 1000
HIGH_OPPORTUNITY = "HIGH"
MEDIUM_OPPORTUNITY = "MEDIUM"
NO_OPPORTUNITY = "NONE"

# Market health: at least so many percent of the products in stock; then the rest.
MARKET_HEALTH = (("HEALTHY", 80), ("MODERATE", 50))
STRESSED = "STRESSED"

# Operation codes of a change log.
OP_CODES = {"insert": "I", "update": "U", "delete": "D"}

# The status that follows each order status.
NEXT_STATUS = {"pending": "confirmed", "confirmed": "shipped", "shipped": "delivered"}

# Defaults of the order and inventory tables.
ORDER_DEFAULTS = {"quantity": 1, "order_status": "pending", "marketplace": "amazon_in"}
INVENTORY_DEFAULTS = {"stock_quantity": 0, "reorder_point": 50}
