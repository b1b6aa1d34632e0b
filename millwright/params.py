"""Tunable values of the pipeline, as frozen dataclasses with working defaults."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime


@dataclass(frozen=True)
class Labels:
    # The reason that marks a breakdown, and the output labels.
    unplanned_reason: str = "Unplanned Breakdown"
    monitoring: str = "monitoring"
    downtime: str = "downtime"
    missing_cost: str = "missing_cost"
    missing_parts: str = "missing_parts"
    unknown_skill: str = "Unknown"
    default_reliability: float = 50.0


@dataclass(frozen=True)
class SeverityLimits:
    """An event is High or Medium when it is strictly above either limit."""

    high_cost: float = 2500
    high_downtime: int = 120
    medium_cost: float = 1500
    medium_downtime: int = 60


@dataclass(frozen=True)
class AlertLimits:
    cost: float = 5000
    downtime: int = 240
    breakdown_pct: float = 30


@dataclass(frozen=True)
class ExpectedRows:
    """Inclusive row-count ranges; ``None`` switches a gate off."""

    events: tuple[int, int] | None = None
    production: tuple[int, int] | None = None
    roster: tuple[int, int] | None = None
    fact: tuple[int, int] | None = None  # None: no fewer than the events


# The ranges expected of the original plant's three files.
PLANT_ROWS = ExpectedRows(
    events=(90, 100), production=(2000, 2100), roster=(18, 22), fact=(90, 100)
)


@dataclass(frozen=True)
class JoinLimits:
    """Where the roster join stops broadcasting, and how fine hot keys are split."""

    broadcast_bytes: int = 64 * 1024 * 1024
    rows_per_task: int = 5_000_000


@dataclass(frozen=True)
class Params:
    source_zone: str = "Europe/Paris"
    labels: Labels = field(default_factory=Labels)
    severity: SeverityLimits = field(default_factory=SeverityLimits)
    alerts: AlertLimits = field(default_factory=AlertLimits)
    expected_rows: ExpectedRows = field(default_factory=ExpectedRows)
    expected_total_cost: tuple[float, float] | None = None
    joins: JoinLimits = field(default_factory=JoinLimits)
    run_ts: datetime | None = None  # UTC load time to record; None is the query's start
    on_fail: str = "warn"  # or "raise"
    clamp_downtime: bool = False
    fill_parts: bool = False
    precision: int = 2
    result_limit: int = 10_000
