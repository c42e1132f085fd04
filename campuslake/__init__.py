"""Effective-dated student-records analytics as lazy Spark DataFrames."""

from campuslake.plans.context import TermQueries
from campuslake.session import configure
from campuslake.sources.warehouse import Warehouse

__all__ = ["TermQueries", "Warehouse", "configure"]
