"""tillgrain: retail customer analytics and data quality as Spark DataFrame jobs.

Every operator is a function ``DataFrame -> DataFrame``; nothing is executed
until the caller writes or collects the result.
"""

from tillgrain.rules import CleanRules

__all__ = ["CleanRules"]
