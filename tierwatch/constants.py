"""These define the semantics and must not be changed to tune results."""

# Compliance labels.
CLEAN = "CLEAN"
VIOLATION_CATEGORIES = (
    "INSIDER_TRADING",
    "CONFIDENTIALITY_BREACH",
    "PERSONAL_TRADING",
    "INFO_BARRIER_VIOLATION",
)
CATEGORIES = (*VIOLATION_CATEGORIES, CLEAN)

# Phrases of the keyword baseline, compared with the lower-cased body.
SUSPICIOUS_PHRASES = (
    "insider", "confidential", "secret", "buy now", "sell before",
    "off the record", "between us", "delete this", "personal trade",
    "between you and me", "heads up", "tip", "private", "sensitive",
    "keep this quiet", "early numbers", "non-public", "mnpi",
)

# Concept phrases of the similarity features, by output column.
CONCEPTS = {
    "baseline_similarity": "quarterly report meeting schedule administrative compliance training office operations normal business",
    "mnpi_risk_score": "material non-public information insider trading tip before announcement confidential merger acquisition",
    "confidentiality_risk_score": "client portfolio details proprietary strategy confidential fee structure private investor information",
    "personal_trading_risk_score": "personal account trade my portfolio bought shares robinhood brokerage unreported position",
    "info_barrier_risk_score": "research rating upgrade downgrade price target analyst opinion before publication trading desk",
}
BASELINE_COLUMN = "baseline_similarity"
RISK_COLUMNS = tuple(c for c in CONCEPTS if c != BASELINE_COLUMN)
FLAG_COLUMN = "cross_barrier_flag"
TARGET_COLUMN = "is_violation"

# Model inputs, in model order.
FEATURE_COLUMNS = (*CONCEPTS, FLAG_COLUMN)

# Departments on both sides of the information barrier.
BARRIER_PAIR = ("Research", "Trading")

# Split, model and decision parameters.
TRAIN_SHARE = 0.8
SPLIT_SEED = 42
N_TREES = 100
TREE_DEPTH = 5
LEARNING_RATE = 0.1
EVALUATION_THRESHOLD = 0.5
HIGH_RISK_AT = 0.7
LOW_RISK_AT = 0.3
REVIEW_CATCH_RATE = 0.90
REVIEW_PASS_RATE = 0.10

# Decisions and the action each one is routed to.
HIGH_RISK, NEEDS_REVIEW, LOW_RISK = "HIGH_RISK", "NEEDS_REVIEW", "LOW_RISK"
ROUTES = {HIGH_RISK: "AUTO_ESCALATE", NEEDS_REVIEW: "LLM_ANALYSIS"}
DEFAULT_ROUTE = "AUTO_CLEAR"

# Lengths of previews in characters.
FEATURE_PREVIEW_CHARS = 200
SEARCH_PREVIEW_CHARS = 300
ERROR_PREVIEW_CHARS = 400

# Vectors and rank fusion.
EMBEDDING_DIM = 768
RRF_CONSTANT = 60
BM25_K1 = 1.2
BM25_B = 0.75
