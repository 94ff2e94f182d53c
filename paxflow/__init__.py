"""paxflow: booking analytics as composable Spark DataFrame operators.

Every public operator is a ``DataFrame -> DataFrame`` function (usable with
``df.transform``) built only from Spark SQL expressions, joins, windows and
aggregations, so Catalyst and AQE plan the work and nothing passes through
the driver.
"""

from paxflow.config import RuleConfig

__all__ = ["RuleConfig"]
