"""Risk / category expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Warning levels in increasing severity, and the probability cuts
# between them (a probability below 0.25 is safe, below 0.40 watch, below 0.60
# alert, otherwise danger).
LEVELS = ("Aman", "Waspada", "Siaga", "Bahaya")
LEVEL_RANK = {name: i for i, name in enumerate(LEVELS)}
PROBABILITY_CUTS = (0.25, 0.40, 0.60)
# Level cuts on rain depth in mm (10, 20, 50).
RAIN_LEVEL_CUTS = (10.0, 20.0, 50.0)
# National daily rain-intensity classes, upper bounds in mm
# (0 exactly = no rain, then <10, <20, <50, <100, otherwise extreme).
RAIN_CATEGORIES = ("Tidak Hujan", "Ringan", "Sedang", "Lebat", "Sangat Lebat", "Ekstrem")
RAIN_CATEGORY_BOUNDS = (10.0, 20.0, 50.0, 100.0)

# The named rain → probability variants.
#   clip80  : clip(r / 80,  0.05, 0.95)   (upload tab of the first dashboard)
#   clip100 : clip(r / 100, 0.05, 0.95)   (upload tab of the final dashboard)
#   clip150 : clip(r / 150, 0.05, 0.95)   (manual forecast generator)
#   lin50   : min(1, r / 50 * 0.8)        (simple hybrid forecast)
#   unit100 : clip(r / 100, 0, 1)         (model-less fallback of the seasonal hybrid)
RISK_VARIANTS = {
    "clip80": (80.0, 0.05, 0.95, 1.0),
    "clip100": (100.0, 0.05, 0.95, 1.0),
    "clip150": (150.0, 0.05, 0.95, 1.0),
    "lin50": (50.0, None, 1.0, 0.8),
    "unit100": (100.0, 0.0, 1.0, 1.0),
}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _cut_chain(x: Column, cuts, labels) -> Column:
    expr = None
    for cut, label in zip(cuts, labels):
        expr = (F.when(x < F.lit(cut), F.lit(label)) if expr is None
                else expr.when(x < F.lit(cut), F.lit(label)))
    return expr.when(x.isNotNull(), F.lit(labels[len(cuts)]))


def risk_level(prob, cuts=PROBABILITY_CUTS) -> Column:
    """Probability → Aman / Waspada / Siaga / Bahaya. NULL stays NULL."""
    return _cut_chain(_col(prob), cuts, LEVELS)


def risk_level_rain(rain, cuts=RAIN_LEVEL_CUTS) -> Column:
    """Rain depth (mm) → level."""
    return _cut_chain(_col(rain), cuts, LEVELS)


def rain_category(rain, compat: bool = False) -> Column:
    """Rain intensity class. With ``compat`` a NULL falls to the last class,
    as a NaN does in plain Python comparisons; otherwise NULL stays NULL."""
    r = _col(rain)
    expr = F.when(r == F.lit(0.0), F.lit(RAIN_CATEGORIES[0]))
    for bound, label in zip(RAIN_CATEGORY_BOUNDS, RAIN_CATEGORIES[1:]):
        expr = expr.when(r < F.lit(bound), F.lit(label))
    last = F.lit(RAIN_CATEGORIES[-1])
    return expr.otherwise(last) if compat else expr.when(r.isNotNull(), last)


def rain_to_risk(rain, variant: str) -> Column:
    """Rain depth → risk probability, one of the named ``RISK_VARIANTS``."""
    scale, lo, hi, gain = RISK_VARIANTS[variant]
    x = _col(rain) / F.lit(scale)
    if gain != 1.0:
        x = x * F.lit(gain)
    x = F.least(F.lit(hi), x)
    if lo is not None:
        x = F.greatest(F.lit(lo), x)
    return F.when(_col(rain).isNotNull(), x)


def level_rank(level) -> Column:
    """Severity rank 0..3 of a level name (NULL for unknown)."""
    lv = _col(level)
    expr = None
    for name, rank in LEVEL_RANK.items():
        expr = (F.when(lv == name, F.lit(rank)) if expr is None
                else expr.when(lv == name, F.lit(rank)))
    return expr


def level_from_rank(rank) -> Column:
    r = _col(rank)
    expr = None
    for name, i in LEVEL_RANK.items():
        expr = F.when(r == i, F.lit(name)) if expr is None else expr.when(r == i, F.lit(name))
    return expr


def round_half_even(x, digits: int) -> Column:
    """banker's rounding on the decimal value."""
    return F.bround(F.round(_col(x), 10), digits)  # first drop what the order of a sum leaves behind


def pct_text(x, digits: int = 1) -> Column:
    """``12.3%`` style text of a 0..1 fraction."""
    return F.concat(F.format_number(_col(x) * 100.0, digits), F.lit("%"))
