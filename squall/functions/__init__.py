"""Column expressions (built-in Spark functions only, no UDFs)."""

from squall.functions import classify, geo, payload, timeutil, urls

__all__ = ["classify", "geo", "payload", "timeutil", "urls"]
