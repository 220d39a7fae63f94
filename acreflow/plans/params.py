"""Every threshold that the questions leave open, with the value used unless a caller gives another."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Params:
    as_of: dt.date = dt.date(2025, 1, 1)
    tenure_years: int = 10
    inclusive: bool = False  # whether exactly ``tenure_years`` is enough
    roof_years: int = 15
    min_acres: float = 40.0
    walking_m: float = 800.0  # straight line, not a route
    water_m: float = 200.0
    power_m: float = 3000.0
    adjacent_m: float = 3000.0
    industrial_zones: tuple[str, ...] = ("M-1", "M-2", "I-1", "I-2", "INDUSTRIAL")
    industrial_permits: tuple[str, ...] = ("INDUSTRIAL", "WAREHOUSE", "SUBSTATION", "DATA CENTER")
    weights: dict[str, float] = field(default_factory=lambda: {"size": 1.0, "tenure": 1.0, "power": 1.0})
