"""Media-event analytics on Spark: event cleaning, viewing sessions, concurrency and merges."""

from beatlake.session import build_session

__all__ = ["build_session"]
