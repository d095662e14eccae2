"""tallyhouse: incremental retail warehouse operators on Spark DataFrames.

Every operator is a pure function DataFrame -> DataFrame. Nothing is
collected to the driver except values whose size is bounded by a
configuration (partition counts, one max id, one control row).
"""

from tallyhouse.context import BatchContext

__all__ = ["BatchContext"]
