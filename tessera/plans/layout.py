"""Folders of a lake and their versions."""

import json
import re
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..sources import sinks, tables

ARTIFACTS = ("normalized", "spans", "beats", "sections", "embeddings", "ann_index")
#: Folder of an artifact and its schema.
SCHEMA_OF = {"normalized": "utterance", "spans": "span", "beats": "beat", "sections": "section", "embeddings": "embedding"}


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str

    def path(self, artifact: str, version: str = "v1") -> str:
        if artifact not in ARTIFACTS:
            raise ValueError(f"unknown artifact {artifact!r}; known: {', '.join(ARTIFACTS)}")
        return f"{self.root}/{artifact}/{version}"

    @property
    def raw(self) -> str:
        return f"{self.root}/raw"

    @property
    def catalogs(self) -> str:
        return f"{self.root}/catalogs"

    def exists(self, artifact: str | None = None, version: str = "v1") -> bool:
        return tables.exists(self.spark, self.path(artifact, version) if artifact else self.root)

    def initialize(self) -> "Lake":
        """The metadata file; folders come with what is written."""
        if not tables.exists(self.spark, f"{self.root}/lake.json"):
            sinks.write_text(self.spark, f"{self.root}/lake.json", json.dumps({"artifacts": list(ARTIFACTS), "format": 1}))
        return self

    def versions(self, artifact: str) -> list[str]:
        """Versions by number, so that v10 comes after v9."""
        names = [p.rstrip("/").rsplit("/", 1)[1] for p, *_ in tables.listing(self.spark, f"{self.root}/{artifact}/v*")]
        return sorted((n for n in names if re.fullmatch(r"v\d+", n)), key=lambda n: int(n[1:]))

    def latest(self, artifact: str) -> str | None:
        return (self.versions(artifact) or [None])[-1]

    def next_version(self, artifact: str) -> str:
        last = self.latest(artifact)
        return f"v{int(last[1:]) + 1}" if last else "v1"

    def summary(self) -> dict[str, list[str]]:
        return {a: self.versions(a) for a in ARTIFACTS}
