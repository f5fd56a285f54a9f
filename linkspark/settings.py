"""Settings of the entity-resolution pipeline."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    #: Features in more target records than this are no probes.
    max_df: int = 10_000
    #: Rarest name and address features by which a query is probed.
    probes_name: int = 5
    probes_addr: int = 5
    #: Touched targets whose cosines are computed, and candidates kept.
    rerank: int = 3000
    top_k: int = 20
    #: Weight of the address cosine in the score.
    addr_weight: float = 1.3
    #: Folds: one in so many entities.
    val_share: int = 5
    fit_share: int = 5
    stop_share: int = 4
    #: Mining: least count and share by kind, and longest residual that is aligned by place.
    min_count_name: int = 3
    min_count_addr: int = 4
    min_count_comp: int = 5
    min_share: float = 0.5
    max_residual: int = 6
    max_pairs: int = 3_000_000
    max_train_rows: int = 8_000_000


DEFAULT = Settings()
