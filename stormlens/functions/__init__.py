"""Column-expression library: every function returns a ``pyspark.sql.Column``.

All are built-in Catalyst expressions (no Python UDFs), so they stay inside
whole-stage code generation wherever they are used.
"""

from stormlens.functions.calendar import (  # noqa: F401
    add_calendar, day_of_week_mon0, days_in_month, month_start, parse_obs_date, season,
)
from stormlens.functions.risk import (  # noqa: F401
    LEVELS, LEVEL_RANK, RAIN_CATEGORIES, level_from_rank, level_rank, rain_category,
    rain_to_risk, risk_level, risk_level_rain, round_half_even, pct_text,
)
