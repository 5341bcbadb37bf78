"""Micro-batch application of a change log and the tables it maintains."""

from tideline.streaming.apply import ChangeSink, rebuild, run_available, start
from tideline.streaming.tables import BatchTable, StateTables

__all__ = ["BatchTable", "ChangeSink", "StateTables", "rebuild", "run_available", "start"]
