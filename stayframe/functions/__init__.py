"""Scalar column helpers (all JVM-side expressions, no Python UDFs)."""
from stayframe.functions.columns import *  # noqa: F401,F403
