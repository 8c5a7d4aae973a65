"""Trade anomaly analytics on Spark DataFrames and Structured Streaming."""

from tickguard.params import FeedRate, VolatilityRule, WindowSpec, ZScoreRule
from tickguard.session import build_session

__all__ = ["FeedRate", "VolatilityRule", "WindowSpec", "ZScoreRule", "build_session"]
