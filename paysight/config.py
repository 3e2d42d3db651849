"""Column names, bounds and modelling constants.

Every operator takes column names as parameters; these defaults describe the
job-postings layout (and the ``postings`` view derived from the driver tables).
"""

from __future__ import annotations

from dataclasses import dataclass

# Fixed values that must equal the original pipeline's settings.
SEED = 42
TEST_SIZE = 0.15
VAL_SIZE = 0.15
N_FOLDS = 5
SALARY_MIN = 15_000.0
SALARY_MAX = 400_000.0
SKILLS_TFIDF_MAX_FEATURES = 3000
TITLE_TFIDF_MAX_FEATURES = 1500
TITLE_TFIDF_MIN_DF = 5
OHE_MIN_FREQUENCY = 10
HIST_BINS = 60
TOP_CATEGORIES = 12
TOP_SKILLS = 25
TOP_PAYING_SKILLS = 20
MIN_SKILL_SUPPORT = 100
LOWER_QUANTILE = 0.05
UPPER_QUANTILE = 0.95
FALLBACK_BAND = 0.15

# Skill categories of the structured skills map, in order.
SKILL_CATEGORIES = ["programming", "databases", "cloud", "libraries",
                    "analyst_tools", "webframeworks", "other"]

# Truthy spellings for boolean-like text flags.
TRUE_TOKENS = ["true", "1", "yes", "t"]

# Seniority keyword groups, tried in this order, and their score.
SENIORITY_RULES = [
    (["intern", "internship", "junior", "jr", "entry", "graduate", "trainee"], -1),
    (["senior", "sr", "lead", "principal", "staff", "head", "manager", "director",
      "chief", "vp"], 2),
    (["mid", "intermediate"], 0),
]

# Contract type (lower case) -> schedule vocabulary; default below.
CONTRACT_MAP = {
    "cdi": "Full-time", "cdd": "Contractor", "permanent": "Full-time",
    "full-time": "Full-time", "part-time": "Part-time",
    "contract": "Contractor", "internship": "Internship",
    "freelance": "Contractor", "temporary": "Temp work",
}
DEFAULT_SCHEDULE = "Full-time"

# Text spellings a CSV reader treats as missing.
CSV_NULL_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN",
                   "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN",
                   "None", "n/a", "nan", "null"]


@dataclass(frozen=True)
class Columns:
    """Names of the posting columns an operator reads."""

    id: str = "posting_id"
    target: str = "salary_year_avg"
    target_hour: str = "salary_hour_avg"
    title: str = "job_title"
    title_short: str = "job_title_short"
    schedule: str = "job_schedule_type"
    rate: str = "salary_rate"
    country: str = "job_country"
    location: str = "job_location"
    company: str = "company_name"
    remote: str = "job_work_from_home"
    no_degree: str = "job_no_degree_mention"
    health: str = "job_health_insurance"
    posted: str = "job_posted_date"
    skills: str = "job_skills"
    type_skills: str = "job_type_skills"


COLS = Columns()

CAT_COUNT_FEATURES = [f"cat_{c}" for c in SKILL_CATEGORIES] + ["n_skill_categories"]
NUMERIC_FEATURES = ["n_skills", "title_len", "title_word_count", "remote_flag",
                    "no_degree_flag", "health_flag", "seniority_score",
                    "posted_month"] + CAT_COUNT_FEATURES
OHE_FEATURES = ["job_title_short", "job_schedule_type", "salary_rate"]
TARGET_ENC_FEATURES = ["job_country", "company_name", "job_location"]
SKILLS_TEXT = "skills_text"
TITLE_TEXT = "job_title"
FEATURE_COLUMNS = NUMERIC_FEATURES + OHE_FEATURES + TARGET_ENC_FEATURES + [SKILLS_TEXT,
                                                                          TITLE_TEXT]


@dataclass
class ModelConfig:
    """Sizes used by the learners."""

    skills_vocab: int = SKILLS_TFIDF_MAX_FEATURES
    title_vocab: int = TITLE_TFIDF_MAX_FEATURES
    title_min_df: int = TITLE_TFIDF_MIN_DF
    ohe_min_frequency: int = OHE_MIN_FREQUENCY
    n_folds: int = N_FOLDS
    seed: int = SEED
    # Trees and boosting rounds of the original learners.
    forest_trees: int = 200
    small_gbt_rounds: int = 150
    xgb_rounds: int = 600
    lgbm_rounds: int = 800
    cat_rounds: int = 600
    # Candidates of the searches, trees of the forest in the stack and the cross-validation.
    lgbm_trials: int = 40
    xgb_trials: int = 25
    stack_trees: int = 400
    #: Depth of forest trees. The driver holds a fitted tree, so without a bound its size
    #: would grow with the rows.
    forest_depth: int = 12
    #: Share of the drawn rounds that the searches' candidates get.
    round_share: float = 1.0
    #: Rounds without a lower validation loss after which M10 stops.
    patience: int = 60
