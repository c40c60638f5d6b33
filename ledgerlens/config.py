"""Default parameters and fixed vocabularies.

Everything under "Fixed values" has to keep exactly these values for results to
be right; everything under "Defaults" is a tunable starting point.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values -----------------------------------------------------------
REQUIRED_COLUMNS = ("description", "category")

SPENDING_CATEGORIES = (
    "Charity & Donations",
    "Entertainment & Recreation",
    "Financial Services",
    "Food & Dining",
    "Government & Legal",
    "Healthcare & Medical",
    "Income",
    "Shopping & Retail",
    "Transportation",
    "Utilities & Services",
)

# Texts a CSV reader of the pandas family treats as missing.
NA_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

PAD_INDEX = 0
UNK_INDEX = 1
FIRST_WORD_INDEX = 2

LATENCY_BOUNDS = (0.01, 0.025, 0.05, 0.1, 0.2, 0.5, 1.0, 2.5)
BATCH_SIZE_BOUNDS = (1.0, 5.0, 10.0, 25.0, 50.0, 100.0, 250.0, 500.0)

MAX_DESCRIPTION_CHARS = 500
MAX_BATCH_ITEMS = 500
MIN_FEEDBACK_SAMPLES = 100
DRIFT_THRESHOLD = 0.10
F1_GATE = 0.70
ERROR_WINDOW = 100


# --- Defaults ---------------------------------------------------------------
@dataclass(frozen=True)
class FeatureParams:
    """Settings of the feature job."""

    max_vocab_size: int = 10_000
    min_freq: int = 2
    max_seq_len: int = 50
    test_size: float = 0.15
    val_size: float = 0.15
    seed: int = 42


@dataclass(frozen=True)
class DriftSplitParams:
    """Settings of the skewed baseline/drift split."""

    baseline_fraction: float = 0.90
    top_categories: int = 3
    top_share: float = 0.75
    seed: int = 42
    threshold: float = DRIFT_THRESHOLD


EARLY_STOP_PATIENCE = 3
RUN_LIST_SIZE = 20
PLOT_SAMPLE_ROWS = 20_000
PLOT_BINS = 40
PREVIEW_ROWS = 10
SCHEMA_SAMPLE_ROWS = 1_000
