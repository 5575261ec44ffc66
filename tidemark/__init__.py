"""tidemark: a weekly per-account feature mart built on Spark DataFrames.

Every function takes and returns DataFrames; the only values that reach the
driver are metadata (category vocabularies, week lists, one scalar per run).
"""

ACCOUNT = "account"
WEEK = "week"
KEYS = (ACCOUNT, WEEK)

__all__ = ["ACCOUNT", "WEEK", "KEYS"]
