"""Feature job: split, vocabulary on the train split only, encoding, baseline."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ledgerlens.config import FeatureParams
from ledgerlens.operators.features import build_vocabulary, encode_texts, feature_baseline, with_special_tokens
from ledgerlens.operators.labels import encode_labels, number_labels
from ledgerlens.operators.profile import value_counts
from ledgerlens.operators.sampling import train_val_test
from ledgerlens.operators.sizing import written
from ledgerlens.sinks.writers import write_lookups, write_table


@dataclass(frozen=True)
class Features:
    """Output of the feature job. `rows` are the split texts before encoding."""

    rows: DataFrame
    features: DataFrame
    vocabulary: DataFrame
    labels: DataFrame
    baseline: DataFrame

    @property
    def train_texts(self) -> DataFrame:
        return self.rows.where("split = 'train'")


def build_features(rows: DataFrame, row_id: str, params: FeatureParams = FeatureParams()) -> Features:
    """`rows` holds row_id, description and category. No test text reaches the vocabulary."""
    counts = written(value_counts(rows))
    labels = written(number_labels(counts))
    split = encode_labels(
        train_val_test(rows, "category", row_id, params.test_size, params.val_size, params.seed, counts), labels)
    vocabulary = build_vocabulary(split.where("split = 'train'"), params.max_vocab_size, params.min_freq)
    features = encode_texts(split, vocabulary, row_id, params.max_seq_len, carry=["split", "label_idx"])
    baseline = feature_baseline(features.where("split = 'train'"))
    return Features(split, features, vocabulary, labels, baseline)


def save_features(made: Features, path: str) -> DataFrame:
    """Write the encoded rows, lookup tables and baseline; return the written rows.

    The baseline is taken from the written train partition, so texts are
    encoded once.
    """
    write_table(made.features, f"{path}/features", partition_by="split")
    stored = made.features.sparkSession.read.parquet(f"{path}/features")
    write_lookups(path, with_special_tokens(made.vocabulary), made.labels, feature_baseline(stored.where("split = 'train'")))
    return stored
