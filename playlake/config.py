"""Job settings: one frozen dataclass passed to every job."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Settings:
    """Paths, source and stream cadence of the pipeline.

    ``checkpoint_root`` defaults to the session's shared checkpoint folder
    (``spark.checkpoint.dir``); every query gets its own sub-folder, versioned
    by ``checkpoint_version`` because changing keys, watermarks or shuffle
    partitions invalidates a stateful checkpoint.
    """

    source: str = "files"  # "kafka" or "files" (NDJSON landing folder)
    landing_path: str = "landing"
    bootstrap_servers: str = "localhost:9092"
    topic: str = "playback-events"
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int | None = None
    max_files_per_trigger: int | None = None
    # Spread each micro-batch over this many tasks before parsing (for small
    # landing files that arrive as one task each); None keeps the source's
    # own partitioning (e.g. one task per topic partition).
    source_partitions: int | None = None
    bronze_path: str = "out/bronze"
    silver_path: str = "out/silver"
    quarantine_path: str = "out/quarantine"
    gold_paths: dict = field(
        default_factory=lambda: {
            "content_hourly": "out/gold/content_hourly",
            "platform_hourly": "out/gold/platform_hourly",
            "content_daily": "out/gold/content_daily",
        }
    )
    checkpoint_root: str | None = None
    checkpoint_version: str = "v1"
    table_format: str = "parquet"  # or "delta" when the connector is present
    watermark_delay: str = "15 minutes"
    trigger_interval: str | None = "15 seconds"  # None -> availableNow
    contract_profile: str = "strict"
    run_id: str | None = None

    def with_(self, **kw) -> Settings:
        return replace(self, **kw)

    @classmethod
    def from_env(cls, prefix: str = "PLAYLAKE_") -> Settings:
        """Settings from ``PLAYLAKE_*`` variables (unset ones keep defaults).

        A mart's path is ``PLAYLAKE_GOLD_<MART>_PATH``, e.g. ``PLAYLAKE_GOLD_CONTENT_HOURLY_PATH``.
        """

        kw: dict = {}
        for name, f in cls.__dataclass_fields__.items():
            if name == "gold_paths":
                paths = {m: os.environ.get(f"{prefix}GOLD_{m.upper()}_PATH", p) for m, p in f.default_factory().items()}
                kw[name] = paths
                continue
            raw = os.environ.get(prefix + name.upper())
            if raw is None:
                continue
            if name in ("max_offsets_per_trigger", "max_files_per_trigger", "source_partitions"):
                kw[name] = int(raw)
            else:
                kw[name] = raw
        return cls(**kw)
