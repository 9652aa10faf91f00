"""Fixed parameters of the forecasting workflow.

Fixed values that must equal the original workflow's defaults for matching
results (feature lists, split ratios, thresholds) are gathered here, in their
natural order.
"""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
LAGS = (1, 2, 3, 7, 14, 21, 30)
ROLLING_WINDOWS = (3, 7, 14, 21, 30)
ROLLING_FUNCTIONS = ("mean", "std", "min", "max", "median")
DATE_PARTS = ("year", "month", "day", "day_of_week", "quarter", "week_of_year",
              "is_weekend", "is_holiday")
TEST_SIZE = 0.1
VALIDATION_SIZE = 0.1
CV_FOLDS = 5
METRICS = ("rmse", "mae", "mape", "r2")
REQUIRED_COLUMNS = ("date", "sales", "store_id", "product_id")
VALUE_RANGES = {"sales": (0.0, 1_000_000.0)}
DRIFT_THRESHOLD = 0.1
ALERT_THRESHOLDS = {"rmse": 1000.0, "mape": 0.2}
PREDICTION_HORIZON = 30
CONFIDENCE_LEVELS = (0.8, 0.95)
TARGET_ENCODING_SMOOTHING = 1.0
IQR_MULTIPLIER = 1.5
OUTLIER_PCT_DIGITS = 2
SHIFT_THRESHOLD = 0.2
MAX_FEATURES = 50
LEAKAGE_CORRELATION = 0.95
MIN_TRAIN_ROWS = 1000
ZERO_TARGET_SHARE = 0.1
STABILITY_WINDOW = 30
TOP_FEATURES_PER_MODEL = 15
THIN_POINTS = 500
MIN_ENSEMBLE_WEIGHT = 0.2
CV_EPSILON = 1e-8
GBT_PARAMS = {"maxDepth": 5, "maxIter": 100, "stepSize": 0.1, "subsamplingRate": 0.8, "seed": 42}
FOREST_PARAMS = {"numTrees": 50, "seed": 42}
FEATURE_IMPORTANCE_THRESHOLD = 0.001
# -----------------------------------------------------------------------------
