"""Change-data engine on Spark DataFrames and Structured Streaming."""

from tideline.rules import Rules
from tideline.session import build_session, new_folder, prepare

__all__ = ["Rules", "build_session", "new_folder", "prepare"]
