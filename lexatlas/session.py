"""Sessions and options. Timestamps are options, never read inside a plan, so that results are reproducible."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Options:
    """What configuration files and constants hold elsewhere."""

    threshold: float = 0.75
    top_k: int = 5
    created_at: str = "1970-01-01T00:00:00"
    model: str = "deterministic"
    version: int = 1
    extra: dict[str, str] = field(default_factory=dict)

    @classmethod
    def load(cls, env_file: str | None = ".env", **given) -> Options:
        """Options from KEY=VALUE lines of env_file, then the environment (LEXATLAS_*), then keyword arguments."""
        found: dict[str, str] = {}
        if env_file and Path(env_file).is_file():
            for line in Path(env_file).read_text(encoding="utf-8").splitlines():
                key, eq, value = line.partition("=")
                if eq and not key.lstrip().startswith("#"):
                    found[key.strip().removeprefix("export ").strip()] = value.strip().strip("'\"")
        found |= {k: v for k, v in os.environ.items() if k.startswith("LEXATLAS_")}
        own = {k.removeprefix("LEXATLAS_").lower(): v for k, v in found.items()}
        kinds = {"threshold": float, "top_k": int, "created_at": str, "model": str, "version": int}
        return cls(**({k: kind(own[k]) for k, kind in kinds.items() if k in own} | {"extra": found} | given))


def session(name: str = "lexatlas", **conf: str) -> SparkSession:
    """A session with adaptive execution on; the master and sizes come from spark-submit or conf."""
    builder = SparkSession.builder.appName(name).config("spark.sql.adaptive.enabled", "true").config("spark.sql.session.timeZone", "UTC")
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
