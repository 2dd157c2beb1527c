"""Run parameters, passed explicitly so that a run can be repeated."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone

from postlode import fixed_values as fixed


@dataclass(frozen=True)
class Params:
    """What a build depends on besides its input tables.

    ``as_of`` takes the place of the wall clock everywhere: activity, freshness
    and the snapshot day are all measured against it.
    """

    as_of: datetime
    active_window_days: int = fixed.ACTIVE_WINDOW_DAYS
    default_region: str = fixed.UNSPECIFIED
    freshness_warn_hours: int = fixed.FRESHNESS_WARN_HOURS
    freshness_error_hours: int = fixed.FRESHNESS_ERROR_HOURS

    def __post_init__(self):
        if self.as_of.tzinfo is None:
            raise ValueError("as_of must carry a time zone")

    @property
    def snapshot_date(self) -> date:
        return self.as_of.astimezone(timezone.utc).date()
