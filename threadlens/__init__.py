"""threadlens: customer-support conversation analytics as Spark jobs.

Operators take DataFrames and return DataFrames; nothing in the core collects
data to the driver.  See README.md for the map from job to module.
"""

from threadlens.session import build_session

__all__ = ["build_session"]
