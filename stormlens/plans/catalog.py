"""Imports every query module so that their ``@register`` decorators run."""

from stormlens.plans import clean_queries  # noqa: F401
from stormlens.plans.registry import ORACLES, QUERIES  # noqa: F401
from stormlens.plans import profile_queries  # noqa: F401,E402
from stormlens.plans import feature_queries  # noqa: F401,E402
from stormlens.plans import forecast_queries  # noqa: F401,E402
from stormlens.plans import eval_queries  # noqa: F401,E402
from stormlens.plans import impute_queries  # noqa: F401,E402
from stormlens.plans import model_queries  # noqa: F401,E402
from stormlens.plans import stream_queries  # noqa: F401,E402
