"""Customer-retention and product-returns analytics as Spark jobs."""

from tidewatch.params import Params
from tidewatch.plans.lake import Lake

__all__ = ["Lake", "Params"]
