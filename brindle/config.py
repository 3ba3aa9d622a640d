"""Configuration: defaults, file and environment over them, checks. Secrets come from the environment only."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Config:
    max_tokens: int = 256
    token_limit: int = 4096
    prompt_margin: int = 3000
    checkpoint_interval: int = 10
    max_retries: int = 3
    cache_ttl: int = 3600
    batch_size: int = 10
    workers: int = 4
    timeout: int = 30
    budget: float = 90.0
    limit: int = 0
    skip_enrichment: bool = False
    output_dir: str = "output"
    provider: str = "offline"
    model: str = ""
    url: str = ""

    def __post_init__(self) -> None:
        for name in ("max_tokens", "token_limit", "batch_size", "workers", "timeout"):
            if getattr(self, name) <= 0:
                raise ValueError(f"{name} must be positive")
        for name in ("max_retries", "cache_ttl", "budget", "limit"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} must not be negative")


@dataclass(frozen=True)
class Thresholds:
    """Trust thresholds and the weights of the signals."""

    deny: float = 0.4
    defer: float = 0.6
    allow: float = 0.8
    weights: tuple[tuple[str, float], ...] = (("docs", 0.4), ("sentiment", 0.3), ("ecosystem", 0.3))

    def __post_init__(self) -> None:
        if not 0 <= self.deny <= self.defer <= self.allow <= 1:
            raise ValueError("thresholds must be in order between 0 and 1")
        if abs(sum(abs(w) for _, w in self.weights) - 1) > 0.01:
            raise ValueError("weights must sum to 1")


PRODUCTION = {"max_retries": 2, "checkpoint_interval": 50, "batch_size": 100}


def _typed(kind: str, value: str) -> object:
    if kind == "bool":
        return value.strip().lower() in ("true", "1", "yes")
    return {"int": int, "float": float}.get(kind, str)(value)


def load(path: str | None = None, production: bool = False, flags: dict | None = None, prefix: str = "BRINDLE_") -> Config:
    """Defaults, then the production profile, environment, flags, and a JSON file, the later over the earlier."""
    known = {f.name: f.type for f in fields(Config)}
    given: dict = dict(PRODUCTION) if production else {}
    given |= {n: _typed(k, os.environ[prefix + n.upper()]) for n, k in known.items() if prefix + n.upper() in os.environ}
    given |= {k: v for k, v in (flags or {}).items() if v is not None}
    if path:
        with open(path) as f:
            given |= json.load(f)
    if unknown := set(given) - set(known):
        raise ValueError(f"unknown settings: {sorted(unknown)}")
    return replace(Config(), **given)
