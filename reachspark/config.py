"""Scenario and policy settings."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

MAX_TRAVEL_MINUTES = 240
UNAVAILABLE = 255


@dataclass(frozen=True)
class Scenario:
    """One service date and the departure window [start, end) in seconds of that service day."""

    service_date: date = date(2026, 9, 7)
    window_start: int = 7 * 3600
    window_end: int = 12 * 3600

    @property
    def gtfs_date(self) -> str:
        return self.service_date.strftime("%Y%m%d")

    @property
    def weekday(self) -> str:
        return self.service_date.strftime("%A").lower()

    @property
    def weekday_index(self) -> int:
        """0 for Sunday."""
        return self.service_date.isoweekday() % 7


@dataclass(frozen=True)
class TransitPolicy:
    station_radius_m: float = 500.0
    rail_boost_percent: float = 25.0
    max_transfers: int = 5
    min_transfer_seconds: int = 120
    max_minutes: int = MAX_TRAVEL_MINUTES
    block_origins: int = 10
    sample_origins: int = 20
    sample_destinations: int = 5


@dataclass(frozen=True)
class RoadPolicy:
    block: int = 50
    snap_concurrency: int = 16
    request_concurrency: int = 4
    attempts: int = 3
    timeout_s: float = 30.0
    sample_pairs: int = 100
    max_minutes: int = MAX_TRAVEL_MINUTES

    def __post_init__(self) -> None:
        if not 1 <= self.block <= 50:
            raise ValueError("a table request has at most 100 coordinates: blocks of 1 to 50")


HEX_DIAMETER_M = 4000.0
SEARCH_LIMIT = 20
