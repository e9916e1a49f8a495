"""Settings read from the environment once, into an immutable value.

No module-level globals: callers build a ``Settings`` and pass it on.
"""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

# Environment variable names users of the original set-up
# already export, mapped to our fields.
ENV_NAMES = {
    "kafka_brokers": "KAFKA_BROKER",
    "kafka_topic": "KAFKA_TOPIC",
    "data_path": "DATA_PATH",
    "checkpoint_path": "SPARK_CHECKPOINT_LOCATION",
    "table_name": "HIVE_TABLE_NAME",
    "trigger_seconds": "SPARK_PROCESSING_INTERVAL",
    "latest_limit": "DASHBOARD_LATEST_LIMIT",
    "starting_offsets": "KAFKA_STARTING_OFFSETS",
    "fail_on_data_loss": "KAFKA_FAIL_ON_DATA_LOSS",
    "max_offsets_per_trigger": "KAFKA_MAX_OFFSETS_PER_TRIGGER",
    "min_partitions": "KAFKA_MIN_PARTITIONS",
}


@dataclass(frozen=True)
class Settings:
    # Default topic and table names of the original deployment.
    kafka_brokers: str = "localhost:9092"
    kafka_topic: str = "energy_stream"
    starting_offsets: str = "earliest"
    fail_on_data_loss: bool = False
    data_path: str = ""
    checkpoint_path: str = ""
    table_name: str = "energy_data"
    trigger_seconds: int = 60
    latest_limit: int = 100
    max_offsets_per_trigger: int = 0  # 0: no cap on a micro-batch
    min_partitions: int = 0  # 0: one task per topic partition

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> "Settings":
        """Build from the environment; unset variables keep the defaults."""
        env = os.environ if env is None else env
        values: dict[str, object] = {}
        for f in fields(cls):
            raw = env.get(ENV_NAMES[f.name])
            if raw is None or raw == "":
                continue
            if f.type in ("bool", bool):
                values[f.name] = raw.strip().lower() in ("1", "true", "yes")
            elif f.type in ("int", int):
                values[f.name] = int(raw)
            else:
                values[f.name] = raw
        return cls(**values)

    @property
    def brokers(self) -> list[str]:
        return [b.strip() for b in self.kafka_brokers.split(",") if b.strip()]
