"""Where a deployment keeps its tables."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Layout:
    """All folders of one deployment, below one root by default."""

    serving: str
    snapshots: str
    snapshot_log: str
    run_log: str
    metrics: str
    archive: str

    @classmethod
    def below(cls, root: str) -> Layout:
        root = root.rstrip("/")
        return cls(
            serving=f"{root}/serving",
            snapshots=f"{root}/partitions",
            snapshot_log=f"{root}/registry/snapshots",
            run_log=f"{root}/registry/runs",
            metrics=f"{root}/registry/metrics",
            archive=f"{root}/archives",
        )

    def table(self, name: str) -> str:
        return f"{self.serving}/{name}"
