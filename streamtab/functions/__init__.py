"""Scalar functions (F1-F12) as JVM-side Column expressions."""
from .scalars import *  # noqa: F401,F403
