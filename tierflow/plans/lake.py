"""Where each layer lives."""

from __future__ import annotations

import os
from dataclasses import dataclass

from tierflow.contracts import Feed
from tierflow.sources.parts import Parted


@dataclass(frozen=True)
class Lake:
    bronze_root: str
    silver_root: str
    gold_root: str
    summary_root: str
    checkpoint_root: str
    # Catalog and schema of the Silver tables, where those take row-level changes.
    silver_catalog: str | None = None
    # Database of the session's catalog where Silver is kept in parts, of which a refresh
    # rewrites those that change; and how many parts a new table gets.
    silver_database: str | None = None
    silver_parts: int = 64

    @classmethod
    def under(cls, root: str, **settings) -> Lake:
        names = ("bronze", "silver", "gold", "summaries", "checkpoints")
        return cls(*(f"{root}/{n}" for n in names), **settings)

    @classmethod
    def from_env(cls) -> Lake:
        """The settings' names and their defaults."""
        get = os.environ.get
        return cls(
            get("BRONZE_PATH", "/data/bronze"),
            get("SILVER_PATH", "/data/silver"),
            get("GOLD_PATH", "/data/gold"),
            get("SUMMARY_PATH", "/data/summaries"),
            get("CHECKPOINT_PATH", "/data/checkpoints"),
            get("SILVER_CATALOG") or None,
            get("SILVER_DATABASE") or None,
            int(get("SILVER_PARTS", "64")),
        )

    def bronze(self, feed: Feed) -> str:
        return f"{self.bronze_root}/{feed.name}"

    def silver(self, feed: Feed) -> str:
        return f"{self.silver_root}/{feed.name}"

    def silver_table(self, feed: Feed) -> str | None:
        """Name of the feed's Silver table in the catalog; None if it is kept as snapshots."""
        return f"{self.silver_catalog}.{feed.name}" if self.silver_catalog else None

    def silver_parted(self, feed: Feed) -> Parted | None:
        """The feed's Silver table in parts; None if it is kept in another way."""
        return Parted(f"{self.silver_database}.{feed.name}", self.silver(feed)) if self.silver_database else None

    def gold(self, mart: str) -> str:
        return f"{self.gold_root}/{mart}"

    def summaries(self, feed: Feed) -> str:
        return f"{self.summary_root}/{feed.name}"

    def checkpoint(self, feed: Feed) -> str:
        return f"{self.checkpoint_root}/{feed.name}"
