"""Hyper-parameters and fixed values, as one frozen dataclass."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, fields


@dataclass(frozen=True)
class Settings:
    # ---- fixed values: must equal the reference's defaults for equal results ----
    # bag-of-words vectoriser
    max_features: int = 10000
    ngram_range: tuple[int, int] = (1, 2)
    min_df: int = 2
    # logistic regression
    logreg_max_iter: int = 2000
    logreg_c: float = 1.0
    class_weight: str = "balanced"
    seed: int = 42
    # split
    val_fraction: float = 0.15
    # ordinal / MLP model
    hidden_dims: tuple[int, ...] = (512, 128)
    num_classes: int = 5
    dropout: float = 0.3
    ordinal: bool = True
    batch_size: int = 32
    epochs: int = 100
    learning_rate: float = 0.002
    early_stopping_patience: int = 10
    # learning-rate-on-plateau schedule (mode max, relative threshold, no cooldown)
    lr_factor: float = 0.5
    lr_patience: int = 3
    lr_threshold: float = 1e-4
    lr_eps: float = 1e-8
    # imbalance grades: < 1.5 balanced, < 3.0 moderate, else significant
    balanced_below: float = 1.5
    moderate_below: float = 3.0
    # profiling
    histogram_bins: int = 50
    preview_chars: int = 300
    inference_preview_chars: int = 100
    samples_per_class: int = 2
    # ---- our own knobs ----
    # annotation files by name (case-sensitive)
    file_glob: str = "*.json"
    # files whose (decoded) path contains this substring are consensus files
    consensus_marker: str = "/consensus/"
    # hashing encoder used when no sentence encoder is plugged in
    embedding_dim: int = 64
    # rank buckets for the stratified split (first hex digits of the row hash)
    split_hash_digits: int = 4
    # vocabulary of more than so many partitions: rare n-grams are kept back by a sketch of two
    # tables of so many counters, with a bound from so large a sample
    sketch_from: int = 64
    sketch_cells: int = 1 << 20
    sketch_sample: float = 0.01
    # iterative fits: feature non-zeros per task at most, at least where cores are idle, and Spark
    # ML's block size (MB)
    fit_nonzeros_per_partition: int = 20_000_000
    fit_nonzeros_least: int = 2_000_000
    fit_block_mb: float = 16.0

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @classmethod
    def from_json(cls, text: str) -> "Settings":
        """Fields that are not known any more are left out, missing ones have their default."""
        known = {f.name for f in fields(cls)}
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(text).items() if k in known})


DEFAULTS = Settings()
