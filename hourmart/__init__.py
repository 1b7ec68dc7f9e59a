"""Hourly market-price and weather analytics on Spark DataFrames."""

from hourmart.session import build_session, prepare

__all__ = ["build_session", "prepare"]
