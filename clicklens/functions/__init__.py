"""Column-level functions (split, cascade, time, JSON forms)."""

from clicklens.functions.columns import *  # noqa: F401,F403
