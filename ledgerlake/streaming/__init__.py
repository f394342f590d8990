"""Incremental (Structured Streaming) form of the Gold layer."""

from .incremental import IncrementalGold, incremental_gold_stream, start_incremental_gold

__all__ = ["IncrementalGold", "incremental_gold_stream", "start_incremental_gold"]
