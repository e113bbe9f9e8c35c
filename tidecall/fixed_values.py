"""Names, word lists and constants that results depend on.

Fixed values. They define the data contract (column lists, label coding,
category groups, cut points, default parameters) and are kept together here so
that every operator reads the same ones.
"""

# Columns of the contact table.
NUMERIC_COLUMNS = ["age", "balance", "day", "duration", "campaign", "pdays", "previous"]
CATEGORICAL_COLUMNS = [
    "job",
    "marital",
    "education",
    "default",
    "housing",
    "loan",
    "contact",
    "month",
    "poutcome",
]
LABEL_COLUMN = "Target"
LOAD_TIME_COLUMN = "update_timestamp_utc"

# Natural keys of the two feature tables and the columns each one publishes.
CUSTOMER_KEY = ["age", "job", "marital", "education", "balance"]
CUSTOMER_FEATURES = ["job_category", "education_level", "balance_positive", "age_group"]
CAMPAIGN_KEY = ["contact", "month", "duration", "campaign", "previous"]
CAMPAIGN_FEATURES = ["month_number", "month_sin", "month_cos", "campaign_intensity", "has_previous"]
CAMPAIGN_LOOKUP = ["month_sin", "month_cos", "campaign_intensity", "has_previous"]
ENGINEERED_COLUMNS = CUSTOMER_FEATURES + CAMPAIGN_FEATURES

# Encodings of "no value" and of the label.
UNKNOWN = "unknown"
MISSING = "missing"
POSITIVE = "yes"
NEGATIVE = "no"

# Category groups and cut points of the derived features.
JOB_GROUPS = {
    "management": ["management", "admin"],
    "services": ["technician", "services"],
    "manual": ["blue-collar"],
}
JOB_OTHER = "other"
EDUCATION_LEVELS = {"tertiary": 3, "secondary": 2, "primary": 1}
AGE_CUTS = [(30, "young"), (50, "middle")]
AGE_REST = "senior"
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]
MONTH_DEFAULT = 6
CAMPAIGN_CUTS = [(2, "low"), (5, "medium")]
CAMPAIGN_REST = "high"

# Defaults for configured columns that a source lacks.
ABSENT_NUMERIC = 0
ABSENT_LABEL = "no"

# Defaults of a nested risk feature.
RISK_SCORE_DEFAULT = 0.5
RISK_CATEGORY_DEFAULT = "MEDIUM"

# Texts of an input record that is absent or incomplete.
NO_INPUT = "No dataset inputs found."
UNKNOWN_URI = "Unknown URI"
UNKNOWN_NAME = "Unknown Name"

# Splitting, scoring and reporting parameters.
SEED = 42
TEST_FRACTION = 0.2
SAMPLE_ROWS = 1000
SAMPLE_FRACTION = 0.1
TRAIN_FRACTION = 0.8
THRESHOLD = 0.5
CONFIDENCE_BOOST = 0.05
MIN_GROUP_ROWS = 10
HIGH_CORRELATION = 0.95
HISTOGRAM_BINS = 20
TOP_CORRELATIONS = 15
TOP_IMPORTANCES = 20

# Classifier parameters and the search grid.
LEARNING_RATE = 0.05
N_ESTIMATORS = 200
MAX_DEPTH = 4
GRID = {"learning_rate": [0.01, 0.05, 0.1], "max_depth": [3, 5, 7], "n_estimators": [50, 100]}

# Decimal numbers as the cleaning step takes them from text.
NUMBER_PATTERN = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf|infinity|nan))\s*$"
