"""Where a run reads and writes."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone


def new_run_id() -> str:
    stamp = datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S")
    return f"{stamp}_{uuid.uuid4().hex[:6]}"


@dataclass(frozen=True)
class Workspace:
    """Zones under one base folder: shared history beside one private folder per run."""

    base: str
    run_id: str = field(default_factory=new_run_id)

    @property
    def raw(self) -> str:
        return f"{self.base}/raw"

    @property
    def contracted(self) -> str:
        return f"{self.base}/contracted"

    @property
    def id_mapping(self) -> str:
        return f"{self.base}/id_mapping"

    @property
    def published(self) -> str:
        return f"{self.base}/published"

    @property
    def version(self) -> str:
        return f"{self.published}/v{self.run_id}"

    @property
    def latest_pointer(self) -> str:
        return f"{self.published}/_latest.json"

    @property
    def pointers(self) -> str:
        return f"{self.published}/pointers"

    @property
    def run_date(self) -> str:
        return f"{self.run_id[:4]}-{self.run_id[4:6]}-{self.run_id[6:8]}"

    @property
    def run(self) -> str:
        return f"{self.base}/runs/{self.run_id}"

    @property
    def staging(self) -> str:
        return f"{self.run}/staging"

    @property
    def pending(self) -> str:
        return f"{self.run}/contracted"

    @property
    def assembled(self) -> str:
        return f"{self.run}/assembled"

    @property
    def semantic(self) -> str:
        return f"{self.run}/semantic"

    @property
    def logs(self) -> str:
        return f"{self.run}/logs"

    @property
    def metadata(self) -> str:
        return f"{self.run}/metadata.json"
