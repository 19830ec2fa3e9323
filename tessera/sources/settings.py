"""Settings from the environment."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class Settings:
    """Each field is read from the variable of its name in capitals, if that is set and not empty."""

    redis_host: str = "localhost"
    redis_port: int = 6379
    redis_db: int = 0
    ddg_max_results: int = 10
    slack_alert_webhook: str | None = None
    local_storage_root: str = "./data"
    static_fallback_root: str = "./data/static_fallback"
    checkpoint_db: str = "./data/checkpoint.db"
    s3_bucket: str | None = None
    aws_region: str = "ap-southeast-1"
    database_url: str = "sqlite:///./data/documents.db"
    celery_broker_url: str = "redis://localhost:6379/1"
    celery_result_backend: str = "redis://localhost:6379/2"
    taxonomy_path: str = "config/esg_taxonomy.json"

    @classmethod
    def load(cls, env: dict[str, str] | None = None) -> Settings:
        env = dict(os.environ) if env is None else env
        found = {f.name: env[f.name.upper()] for f in fields(cls) if env.get(f.name.upper())}
        return cls(**{k: int(v) if isinstance(getattr(cls, k), int) else v for k, v in found.items()})
