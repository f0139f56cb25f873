"""Registered plans: importing this package registers every plan module."""

from .registry import ORACLES, PLANS, register, table  # noqa: F401
from . import evaluation, modelling, monitoring, profiling, series, statistics  # noqa: F401

__all__ = ["PLANS", "ORACLES", "register", "table"]
