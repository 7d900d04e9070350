"""feedlake: a PySpark-native transit-feed lake.

Every public operator is a function over Spark DataFrames or Columns. Nothing
collects row data to the driver; heavy work is joins, aggregates, windows and
higher-order functions that Catalyst plans and Tungsten executes.
"""

from feedlake.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
__version__ = "0.1.0"
