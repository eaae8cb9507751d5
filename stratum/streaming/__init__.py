"""Structured Streaming support: fitted stateless steps applied to streaming DataFrames."""
from .apply import apply_params, stream_prepare

__all__ = ["apply_params", "stream_prepare"]
