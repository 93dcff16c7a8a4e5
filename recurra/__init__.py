"""recurra: recurring-revenue (ARR) analytics on Spark DataFrames.

Refund matching, annualised order value, monthly ARR expansion, customer
rollforward with movement labels, and the final ARR table for the whole
business and every product in one plan.
"""

from .config import Config, PriceRules
from .plans.pipeline import Pipeline
from .sources.tables import Inputs, read_inputs

__all__ = ["Config", "PriceRules", "Pipeline", "Inputs", "read_inputs"]
