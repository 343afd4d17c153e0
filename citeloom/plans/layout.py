"""Zone folders and content-addressed run paths."""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.sql import SparkSession

# Names of the root setting and of the zones.
ROOT_CONF = "citeloom.data.root"
ROOT_ENV = "CITELOOM_DATA_ROOT"
DEFAULT_ROOT = "data"


@dataclass(frozen=True)
class DataLayout:
    """Where runs are written. Folders appear when something is written to them."""

    root: str = DEFAULT_ROOT

    @classmethod
    def from_session(cls, spark: SparkSession) -> "DataLayout":
        """Root from the session setting, else the environment, else ``data``."""
        return cls(
            spark.conf.get(ROOT_CONF, None) or os.environ.get(ROOT_ENV) or DEFAULT_ROOT
        )

    def zone(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    @property
    def raw(self) -> str:
        return self.zone("raw")

    @property
    def interim(self) -> str:
        return self.zone("interim")

    @property
    def processed(self) -> str:
        return self.zone("processed")

    @property
    def final(self) -> str:
        return self.zone("final")

    def search_run(self, digest: str, day: str) -> str:
        return f"{self.raw}/pubmed/{digest}/{day}"

    def resolve_run(self, digest: str) -> str:
        return f"{self.interim}/resolved/{digest}"

    def merge_run(self, digest: str) -> str:
        return f"{self.processed}/merged/{digest}"

    def fulltext_run(self, digest: str) -> str:
        return f"{self.processed}/fulltext/{digest}"
