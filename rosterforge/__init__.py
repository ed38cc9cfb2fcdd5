"""Entity quality and prospect scoring on Spark DataFrames."""

from rosterforge.config import Config

__all__ = ["Config"]
