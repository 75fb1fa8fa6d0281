"""lakehand: metadata-driven lakehouse ELT operators on Spark DataFrames.

Every operator is a plain DataFrame -> DataFrame function; planning is left to
Catalyst and AQE.  Only the ``sinks`` package writes data.
"""

from lakehand.session import checkpoint_dir, get_spark  # noqa: F401

__all__ = ["get_spark", "checkpoint_dir"]
