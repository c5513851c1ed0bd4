"""Where a workspace's tables and files lie, and the settings of its jobs."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Workspace:
    """Folders below one root; any file system that Spark and its workers reach."""

    root: str

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def inbox(self) -> str:
        return self._at("inbox")

    @property
    def mappings(self) -> str:
        return self._at("mappings")

    def dataset(self, name: str) -> dict[str, str]:
        """Fact, quarantine, registry, run logs, stages, watermark and lock of a dataset."""
        return {part: self._at(name, part) for part in ("fact", "quarantine", "unreadable", "registry", "run_logs", "stages", "watermark", "lock", "archive", "rejected", "reports")}


@dataclass(frozen=True)
class Settings:
    """Settings of the jobs; ``required`` columns make a row valid."""

    zone: str = "Europe/Athens"
    most_invalid_pct: float | None = 20.0
    required: tuple[str, ...] = ("ts_utc", "park_id", "signal_name", "ingest_key")
    compression: str = "zstd"
    keep_stages: int | None = 5
    stuck_readings: int = 5
    spark: dict[str, str] = field(default_factory=lambda: {"spark.sql.adaptive.enabled": "true", "spark.sql.session.timeZone": "UTC", "spark.sql.parquet.compression.codec": "zstd"})
