"""Build and maintain a dimensional warehouse with Spark DataFrames."""

from dimflow.registry import TableSpec
from dimflow.session import configure

__all__ = ["TableSpec", "configure"]
