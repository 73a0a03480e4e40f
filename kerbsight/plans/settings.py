"""Settings of a run: frozen, validated, from nested maps or job parameters."""

from __future__ import annotations

import datetime
from collections.abc import Mapping
from dataclasses import dataclass, field, fields

from kerbsight.operators.detections import BOX_AREA, CLUSTER_METRES, CONFIDENCE, MAX_DELAY, MIN_SCORE, SEND_LIMITS


@dataclass(frozen=True)
class Settings:
    """Thresholds and limits by class, districts, dates. A negative send limit means none."""

    districts: tuple[str, ...] = ()
    confidence: Mapping[int, float] = field(default_factory=lambda: dict(CONFIDENCE))
    box_area: Mapping[int, float] = field(default_factory=lambda: dict(BOX_AREA))
    cluster_metres: Mapping[int, float] = field(default_factory=lambda: dict(CLUSTER_METRES))
    send_limits: Mapping[int, int] = field(default_factory=lambda: dict(SEND_LIMITS))
    min_score: float = MIN_SCORE
    max_delay: int = MAX_DELAY
    retention_weeks: int = 52
    date: datetime.date | None = None
    skip_ids: tuple[int, ...] = ()
    exclude_private: bool = False

    def __post_init__(self):
        if not 0 <= self.min_score <= 1:
            raise ValueError(f"min_score {self.min_score} is outside 0 to 1")
        if self.retention_weeks < 0 or self.max_delay < 0:
            raise ValueError("negative retention or delay")
        for name in ("confidence", "box_area"):
            if bad := {k: v for k, v in getattr(self, name).items() if not 0 <= v <= 1}:
                raise ValueError(f"{name} outside 0 to 1: {bad}")
        if missing := set(self.send_limits) - set(self.confidence):
            raise ValueError(f"no confidence threshold for classes {sorted(missing)}")

    @property
    def cutoff(self) -> datetime.date:
        """First day that retention keeps."""
        return (self.date or datetime.date.today()) - datetime.timedelta(weeks=self.retention_weeks)


def from_map(values: Mapping) -> Settings:
    """Settings out of a nested map; an unknown key is an error."""
    known = {f.name for f in fields(Settings)}
    if extra := set(values) - known:
        raise ValueError(f"unknown settings: {sorted(extra)}")
    by_class = lambda x: {int(k): v for k, v in x.items()}
    return Settings(**{k: by_class(v) if isinstance(v, Mapping) else tuple(v) if isinstance(v, list) else v for k, v in values.items()})


def from_parameters(base: Settings, date: str = "", districts: str = "", send_limits: str = "", skip_ids: str = "") -> Settings:
    """Settings with what a job's text parameters say: ISO date, comma lists, ``class:limit`` pairs; empty ones change nothing."""
    items = lambda s: [x.strip() for x in s.split(",") if x.strip()]
    change: dict = {}
    if date.strip():
        change["date"] = datetime.date.fromisoformat(date.strip())
    if items(districts):
        change["districts"] = tuple(x.capitalize() for x in items(districts))
    if items(send_limits):
        change["send_limits"] = {int(k): int(v) for k, v in (x.split(":") for x in items(send_limits))}
    if items(skip_ids):
        change["skip_ids"] = tuple(int(x) for x in items(skip_ids))
    return Settings(**{f.name: getattr(base, f.name) for f in fields(base)} | change)
