"""Fixed values and tunable parameters, in one place."""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: names and formats an existing user relies on ---------------

RAW_COLUMNS = ("timestamp", "price", "user_id")
EXPECTED_MAIN = ("2012-1.csv", "2012-2.csv", "2012-3.csv", "2012-4.csv", "2012-5.csv")
HELD_OUT = "validation.csv"
BRONZE_CREATED_BY = "bronze_converter"
STATS_METRICS = ("count", "avg", "min", "max")

# Text that the pandas CSV reader takes as missing (public pandas documentation).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# --- Fixed defaults: declared thresholds; every function that uses one takes another value ---------------------------------------------

BATCH_SIZE = 1000
PROGRESS_EVERY = 5
FILES_PER_LOAD = 1000  # per micro-batch, so that the first load is not replayed as a whole
TOLERANCE = 1e-6
USER_ID_PATTERN = r"^user_\d+$"
UNKNOWN_USER = "unknown"
# Larger prices are rejected: their cents are no longer exact, and sums of them would not fit.
MAX_PRICE = 1e13
PRICE_RANGE = {"bronze": (0.01, 50000.0), "silver": (0.01, 10000.0)}
METRIC_RANGE = (-1e6, 1e6)
OUTLIER_STD = 3.0
NULL_TOLERANCE = {"quality": 0.01, "bronze": 0.0, "silver": 0.0, "gold": 0.0}
DUPLICATE_TOLERANCE = {"quality": 0.0, "bronze": 1.0, "silver": 0.0, "gold": 0.0}
PRICE_SPIKE = 2.0
COUNT_ANOMALY = 0.1
MAX_HISTORY = 1000
RETENTION_DAYS = {"bronze": 365, "silver": 730, "gold": -1}
ARCHIVE_TIER = {"bronze": "cold", "silver": "warm", "gold": "hot"}
QUALITY_TIER = {"bronze": "raw", "silver": "clean", "gold": "analytics_ready"}
CREATED_BY = {
    "bronze": "bronze_converter",
    "silver": "silver_processor",
    "gold": "gold_aggregator",
}
DATA_SOURCE = {
    "bronze": "csv_files",
    "silver": "bronze_layer",
    "gold": "silver_layer",
}
PROCESSING_VERSION = "1.0"
LAYER_OK_FILES = 5
GATE_FILES = 6

# Tried after ISO 8601, which Spark's own cast reads.
TIMESTAMP_FORMATS = ("M/d/yyyy H:mm:ss", "M/d/yyyy")


@dataclass(frozen=True)
class Feed:
    """Which sources are loaded first and which one is held out."""

    main: tuple[str, ...] = EXPECTED_MAIN
    held_out: str = HELD_OUT
    timestamp_min: str = "2012-01-01"
    timestamp_max: str = "2012-12-31"

    @property
    def expected(self) -> tuple[str, ...]:
        return (*self.main, self.held_out)
