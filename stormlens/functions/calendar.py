"""Calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The season of each calendar month, as defined by the studied
# rain-season calendar (wet season Dec-Mar, first transition Apr-May, dry season
# Jun-Sep, second transition Oct-Nov).
SEASON_WET = "Hujan_Intensif"
SEASON_TRANSITION_1 = "Peralihan_1"
SEASON_DRY = "Kemarau"
SEASON_TRANSITION_2 = "Peralihan_2"
SEASON_MONTHS = {
    SEASON_WET: (12, 1, 2, 3),
    SEASON_TRANSITION_1: (4, 5),
    SEASON_DRY: (6, 7, 8, 9),
}
SEASONS = (SEASON_DRY, SEASON_WET, SEASON_TRANSITION_1, SEASON_TRANSITION_2)  # sorted


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_obs_date(ts) -> Column:
    """Day of a reading.

    Text timestamps such as ``"2015-01-01 00:00:00.0 +0:00"`` keep only the first
    token (the day as written, no time-zone arithmetic); timestamp / date columns
    are truncated with ``to_date``.
    """
    c = _col(ts)
    return F.to_date(F.split(c.cast("string"), " ").getItem(0))


def day_of_week_mon0(d) -> Column:
    """Weekday with Monday = 0 … Sunday = 6 (``weekday``, not ``dayofweek``)."""
    return F.weekday(_col(d))


def season(month) -> Column:
    m = _col(month)
    return (F.when(m.isin(*SEASON_MONTHS[SEASON_WET]), F.lit(SEASON_WET))
            .when(m.isin(*SEASON_MONTHS[SEASON_TRANSITION_1]), F.lit(SEASON_TRANSITION_1))
            .when(m.isin(*SEASON_MONTHS[SEASON_DRY]), F.lit(SEASON_DRY))
            .when(m.isNotNull(), F.lit(SEASON_TRANSITION_2)))


def month_start(d) -> Column:
    return F.trunc(_col(d), "MM")


def days_in_month(d) -> Column:
    return F.dayofmonth(F.last_day(_col(d)))


def add_calendar(df: DataFrame, date_col: str = "obs_date") -> DataFrame:
    """X1 + X2: month, day of year, weekday (Mon=0), year and season columns."""
    d = F.col(date_col)
    # Column names of the feature table that trained models expect.
    return df.withColumns({
        "bulan": F.month(d),
        "hari_tahun": F.dayofyear(d),
        "hari_minggu": day_of_week_mon0(d),
        "tahun": F.year(d),
        "musim": season(F.month(d)),
    })
