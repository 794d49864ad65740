"""Settings, as nested dataclasses with JSON overrides."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields
from pathlib import Path


# Names and defaults of the settings (training's own are explained in the README).


@dataclass
class BlockingConfig:
    char_ngram_range: tuple[int, int] = (3, 4)
    char_min_df: int = 5
    #: Grams in more than this share of records don't retrieve neighbours (they still count in scores); 1.0 is exact.
    retrieval_max_df: float = 1.0
    retrieval_ngram_range: tuple[int, int] = (3, 4)
    name_k: int = 20
    address_k: int = 10
    combined_k: int = 20
    combined_name_weight: float = 0.6
    rare_min_df: int = 30
    rare_df_frac: float = 0.002
    rare_tokens_per_record: int = 2
    use_exact_keys: bool = True
    key_max_bucket: int = 200
    use_postal_block: bool = True
    postal_max_bucket: int = 400
    postal_k: int = 5
    postal_min_cosine: float = 0.1
    use_acronym_block: bool = True
    acronym_head: int = 50
    max_candidates_per_source: int = 20
    keep_top_name: int = 10
    keep_top_address: int = 5
    keep_address_cosine: float = 0.5
    min_cheap_score: float = 0.05


@dataclass
class ModelConfig:
    n_folds: int = 5
    seed: int = 42
    max_iter: int = 300
    max_depth: int = 6
    learning_rate: float = 0.1
    min_instances: int = 40
    feature_fraction: str = "0.8"
    bagging_fraction: float = 0.8
    max_bins: int = 128
    calibrate: bool = True


@dataclass
class DecisionConfig:
    beta: float = 0.5
    threshold_grid: tuple[float, ...] = tuple(round(0.05 + 0.01 * i, 2) for i in range(91))
    source_threshold_grid: tuple[float, ...] = tuple(round(0.10 + 0.05 * i, 2) for i in range(18))
    expected_f_gamma_grid: tuple[float, ...] = (0.8, 1.0, 1.25, 1.5)
    min_prob: float = 1e-3
    try_exclusive: bool = True
    tolerance: float = 0.0005


# End of the fixed values.


@dataclass
class Config:
    blocking: BlockingConfig = field(default_factory=BlockingConfig)
    model: ModelConfig = field(default_factory=ModelConfig)
    decision: DecisionConfig = field(default_factory=DecisionConfig)

    def to_dict(self) -> dict:
        return asdict(self)

    @classmethod
    def from_dict(cls, overrides: dict) -> Config:
        """Defaults with overrides; an unknown section or key is a KeyError."""
        config = cls()
        for section, values in overrides.items():
            if section not in {f.name for f in fields(cls)}:
                raise KeyError(section)
            part = getattr(config, section)
            known = {f.name for f in fields(part)}
            for key, value in values.items():
                if key not in known:
                    raise KeyError(f"{section}.{key}")
                setattr(part, key, tuple(value) if isinstance(getattr(part, key), tuple) else value)
        return config

    @classmethod
    def load(cls, path: str | Path | None) -> Config:
        return cls() if path is None else cls.from_dict(json.loads(Path(path).read_text("utf-8")))
