"""Marketplace analytics on Spark: DataFrames in, DataFrames out."""

from tradewinds.session import build_session, prepare
from tradewinds.tables import RawTables

__all__ = ["RawTables", "build_session", "prepare"]
