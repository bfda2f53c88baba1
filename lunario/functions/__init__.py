"""Column expressions: dates, period labels and number repair."""

from lunario.functions.dates import (
    lenient_timestamp,
    month_of_abbreviation,
    normalise_period_part,
    period_label,
    strict_date,
)
from lunario.functions.finance import gdp_number, index_number

__all__ = [
    "gdp_number",
    "index_number",
    "lenient_timestamp",
    "month_of_abbreviation",
    "normalise_period_part",
    "period_label",
    "strict_date",
]
