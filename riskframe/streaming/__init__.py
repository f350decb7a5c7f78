"""Structured Streaming: score arriving rows with a fitted model."""

from riskframe.streaming.scoring import score_stream

__all__ = ["score_stream"]
