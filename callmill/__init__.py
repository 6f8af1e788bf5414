"""Call-booking and marketing-spend analytics on Spark DataFrames."""

from callmill.session import build_session, configure

__all__ = ["build_session", "configure"]
