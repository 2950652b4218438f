"""Run configuration: where the three layers live, and who is running."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import datetime, timezone


def _strip(root: str) -> str:
    return root.rstrip("/") if root not in ("/", "") else root


# Where a table lies under its layer's root.
LAYER_PATHS = {
    "bronze": "{root}/raw/public/{table}",
    "silver": "{root}/{table}",
    "quarantine": "{root}/{table}",
}


@dataclass(frozen=True)
class Paths:
    """Roots of the raw (Bronze), Silver and quarantine layers.

    raw table        = ``{bronze_root}/raw/public/{table}``
    silver table     = ``{silver_root}/{table}``
    quarantine table = ``{quarantine_root}/{table}``

    Trailing slashes on the roots are ignored, so ``s3://b/`` and ``s3://b``
    give the same table paths.
    """

    bronze_root: str
    silver_root: str
    quarantine_root: str

    def __post_init__(self):
        for name in ("bronze_root", "silver_root", "quarantine_root"):
            object.__setattr__(self, name, _strip(getattr(self, name)))

    def table(self, layer: str, name: str) -> str:
        """Path of a table in a layer, by the layer's template."""
        return LAYER_PATHS[layer].format(root=getattr(self, f"{layer}_root"), table=name)

    def bronze_table(self, table: str) -> str:
        return self.table("bronze", table)

    def silver_table(self, table: str) -> str:
        return self.table("silver", table)

    def quarantine_table(self, table: str) -> str:
        return self.table("quarantine", table)

    @classmethod
    def under(cls, root: str) -> Paths:
        root = _strip(root)
        return cls(f"{root}/bronze", f"{root}/silver", f"{root}/quarantine")


# Argument names of the three layer roots.
PATH_ARGS = ("BRONZE_PATH", "SILVER_PATH", "QUARANTINE_PATH")


def resolve_paths(args: dict) -> Paths:
    """Paths from job arguments (``BRONZE_PATH``, ``SILVER_PATH``, ``QUARANTINE_PATH``)."""
    missing = [a for a in PATH_ARGS if a not in args]
    if missing:
        raise KeyError(f"missing job arguments: {missing}")
    return Paths(args["BRONZE_PATH"], args["SILVER_PATH"], args["QUARANTINE_PATH"])


def environment_from_job_name(job_name: str) -> str:
    """Second ``-`` segment of a job name (``proj-dev-dim_customer`` -> ``dev``),
    else ``unknown``."""
    parts = job_name.split("-")
    return parts[1] if len(parts) > 1 else "unknown"


# Cut-off instant freshness is measured against, and the stale
# threshold in hours.
REFERENCE_TIME = datetime(2026, 3, 2, 23, 59, 59, tzinfo=timezone.utc)
STALE_AFTER_HOURS = 24.0
# Fixed value: largest tolerated relative gap between two layers' row counts.
DIVERGENCE_THRESHOLD = 0.05


@dataclass(frozen=True)
class RunConfig:
    paths: Paths
    run_id: str = field(default_factory=lambda: datetime.now(timezone.utc).strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:6])
    environment: str = "unknown"
    reference_time: datetime = REFERENCE_TIME
    stale_after_hours: float = STALE_AFTER_HOURS
    metrics_path: str | None = None     # append metric rows here when set
    fail_on_empty: bool = False         # raise when a table writes zero valid rows
