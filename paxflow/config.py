"""Run parameters, held as a frozen dataclass and inlined as plan literals."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

# Fixed values that define the report's semantics.
DEFAULT_AIRLINE = "KL"
DEFAULT_ORIGINS = ("AMS", "EIN", "RTM", "GRQ", "MST")
CONFIRMED = "CONFIRMED"
CANCELLED = "CANCELLED"
ADULT = "ADT"
CHILD = "CHD"
HOME_COUNTRY = "Netherlands"

TZ_FROM = ("origin", "destination")
TIE_BREAKS = ("cancelled_first", "confirmed_first")


def _as_date(value) -> dt.date | None:
    if value is None or isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        return value
    if isinstance(value, dt.datetime):
        return value.date()
    return dt.date.fromisoformat(str(value).strip())


def parse_codes(text: str | None) -> tuple[str, ...]:
    """Comma separated airport codes -> trimmed upper-case tuple."""
    if not text:
        return ()
    return tuple(c.strip().upper() for c in text.split(",") if c.strip())


@dataclass(frozen=True)
class RuleConfig:
    """Business rules of the passenger report.

    ``start``/``end`` bound the UTC calendar date of departure, inclusive;
    ``None`` leaves that side open. ``tz_from`` picks the airport whose zone
    gives the local day of week. ``tie_break`` orders events with equal
    timestamps. ``strict`` drops a whole event when any member is invalid
    instead of only the offending passenger-leg.
    """

    start: dt.date | None = None
    end: dt.date | None = None
    airline: str = DEFAULT_AIRLINE
    origins: tuple[str, ...] = DEFAULT_ORIGINS
    tz_from: str = "origin"
    tie_break: str = "cancelled_first"
    strict: bool = False

    def __post_init__(self):
        object.__setattr__(self, "start", _as_date(self.start))
        object.__setattr__(self, "end", _as_date(self.end))
        origins = self.origins
        if isinstance(origins, str):
            origins = parse_codes(origins)
        if origins is not None:  # None: no origin rule (e.g. origins joined from data); empty: the defaults
            object.__setattr__(self, "origins", tuple(c.strip().upper() for c in origins) or DEFAULT_ORIGINS)
        if self.start and self.end and self.end < self.start:
            raise ValueError(f"end date {self.end} is before start date {self.start}")
        if self.tz_from not in TZ_FROM:
            raise ValueError(f"tz_from must be one of {TZ_FROM}")
        if self.tie_break not in TIE_BREAKS:
            raise ValueError(f"tie_break must be one of {TIE_BREAKS}")

    def with_(self, **changes) -> "RuleConfig":
        values = {k: getattr(self, k) for k in self.__dataclass_fields__}
        values.update(changes)
        return RuleConfig(**values)
