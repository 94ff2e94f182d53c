"""Column expressions (built-in Spark functions only, codegen friendly)."""

from paxflow.functions.instants import (
    departure_window,
    instant_micros,
    local_day_name,
    season_of,
    utc_date,
    utc_instant,
)
from paxflow.functions.text import code_list, upper_trim

__all__ = [
    "code_list",
    "departure_window",
    "instant_micros",
    "local_day_name",
    "season_of",
    "upper_trim",
    "utc_date",
    "utc_instant",
]
