"""Folder layout of the lake."""

from __future__ import annotations

from dataclasses import dataclass

from touchline.sources.storage import join_path


@dataclass(frozen=True)
class Lake:
    """Paths under one root. The folder names are parameters; the root may be on any Spark file system."""

    root: str
    raw: str = "bronze/raw"
    metadata: str = "bronze/metadata"
    silver: str = "silver"
    gold: str = "gold"
    marts: str = "gold/marts"
    quality: str = "quality"
    check_counts: str = "check_counts"

    def raw_root(self) -> str:
        return join_path(self.root, self.raw)

    def raw_source(self, source: str) -> str:
        return join_path(self.raw_root(), f"source={source}")

    def raw_load(self, source: str, load_date: str) -> str:
        return join_path(self.raw_source(source), f"load_date={load_date}")

    def manifest(self) -> str:
        return join_path(self.root, self.metadata)

    def manifest_source(self, source: str) -> str:
        return join_path(self.manifest(), f"source={source}")

    def manifest_of(self, source: str, load_date: str) -> str:
        return join_path(self.manifest_source(source), f"load_date={load_date}")

    def silver_table(self, name: str) -> str:
        return join_path(self.root, self.silver, name)

    def gold_table(self, name: str) -> str:
        return join_path(self.root, self.gold, name)

    def mart(self, name: str) -> str:
        return join_path(self.root, self.marts, name)

    def quarantine(self, dataset: str) -> str:
        return join_path(self.root, self.quality, dataset)

    def counts_of_checks(self, dataset: str) -> str:
        return join_path(self.root, self.check_counts, dataset)
