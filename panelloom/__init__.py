"""Entity x year panels and next-period forecast evaluation on Spark DataFrames."""

from panelloom.session import configure

__all__ = ["configure"]
