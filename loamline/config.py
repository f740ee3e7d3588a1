"""Tunables, passed in as frozen values; nothing reads the environment."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Clean:
    min_chars: int = 50
    max_chars: int = 100_000
    garbage_max: float = 0.30
    repeat_max: float = 0.50
    near_threshold: float = 0.85
    shingle: int = 5
    permutations: int = 128
    languages: tuple[str, ...] = ("en",)


@dataclass(frozen=True)
class Gate:
    min_total: int = 50
    min_subdomain: int = 5
    max_source_share: float = 0.60
    max_drift: float = 0.25
    max_dup_rate: float = 0.40
    min_avg_tokens: float = 5.0
    max_topic_cv: float = 1.5
    min_subdomain_share: float = 0.01


@dataclass(frozen=True)
class LightGate:
    sample: int = 200
    max_empty: float = 0.80
    max_garbage: float = 0.50


@dataclass(frozen=True)
class Normalize:
    text_floor: int = 20
    near_threshold: float = 0.65
    escalate: int = 5
    pause: int = 20


BALANCE_RATIO = 5.0
SEED = 42
