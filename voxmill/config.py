"""Parameters and column lists whose values define the results."""

DOMAINS = ("Electronics", "Fashion")
COMBINED = "Combined"

MIN_REVIEWS_PER_PRODUCT = 20
SEED = 42

MIN_WORDS = 3
MIN_CHARS = 10
MAX_CHARS = 1000

LABELS = ("negative", "neutral", "positive")
LABEL_REPORT_ORDER = ("positive", "neutral", "negative")

RUN_ASPECT_THRESHOLD = 0.35

REVIEW_COLUMNS = (
    "rating", "title", "text", "asin", "parent_asin", "user_id",
    "timestamp", "helpful_vote", "verified_purchase",
)
METADATA_COLUMNS = (
    "parent_asin", "title", "average_rating", "price", "description", "categories", "store",
)
REVIEW_OUTPUT_COLUMNS = (
    "row_id", "domain", "parent_asin", "asin", "rating", "sentiment", "title", "text",
    "timestamp", "helpful_vote", "verified_purchase",
)
PRODUCT_OUTPUT_COLUMNS = (
    "domain", "parent_asin", "title", "average_rating", "price",
    "description", "categories", "store",
)
