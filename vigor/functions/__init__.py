"""Column -> Column building blocks (no Python UDFs)."""

from .exprs import *  # noqa: F401,F403
