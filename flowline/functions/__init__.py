"""Scalar column functions (labels, paths, hashing, arrays, schedules)."""

from flowline.functions.columns import *  # noqa: F401,F403
