"""Settings from the environment."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    warehouse: str
    api_url: str = "https://clinicaltrials.gov/api/v2/studies"
    lookback_days: int = 2
    requests_per_minute: int = 40
    page_size: int = 1000
    max_retries: int = 5
    status_page: str = "status/index.html"
    buckets: int = 8
    bucket_files: int = 1

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Config:
        """TIDEWATER_WAREHOUSE is required; the others have defaults."""
        env = os.environ if env is None else env
        if not env.get("TIDEWATER_WAREHOUSE"):
            raise RuntimeError("TIDEWATER_WAREHOUSE must name the folder of the tables")
        found = {}
        for name, field in cls.__dataclass_fields__.items():
            value = env.get(f"TIDEWATER_{name.upper()}")
            if value:
                found[name] = int(value) if field.type == "int" else value
        return cls(**found)
