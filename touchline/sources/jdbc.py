"""Relational sink."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class JdbcTarget:
    """Connection settings. ``max_connections`` bounds the write tasks, whatever the size of the table."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    schema: str = "analytics"
    max_connections: int = 16
    rows_per_batch: int = 10_000
    truncate: bool = True
    cascade_truncate: bool = True

    def options(self, table: str) -> dict[str, str]:
        options = {
            **self.properties,
            "url": self.url,
            "dbtable": f"{self.schema}.{table}",
            "numPartitions": str(self.max_connections),
            "batchsize": str(self.rows_per_batch),
        }
        if self.truncate:
            # Keep the declared keys and indexes: empty the table instead of dropping it. A table that foreign keys
            # refer to can only be emptied together with the referring ones, which are loaded after it.
            options |= {"truncate": "true", "cascadeTruncate": str(self.cascade_truncate).lower()}
        return options


def write_jdbc(frame: DataFrame, target: JdbcTarget, table: str, mode: str = "overwrite") -> None:
    frame.write.format("jdbc").options(**target.options(table)).mode(mode).save()
