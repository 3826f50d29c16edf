"""assetrank: rank assets from daily price histories on Spark.

Every public operator is a lazy ``DataFrame -> DataFrame`` function built from
Spark's own column, window and aggregate expressions.
"""

from assetrank.config import Defaults, shared_dir
from assetrank.plans.rank import rank_investments

__all__ = ["Defaults", "shared_dir", "rank_investments"]
