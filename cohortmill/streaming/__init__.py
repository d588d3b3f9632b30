"""Incremental processing of arriving files with Structured Streaming."""

from .incremental import handled_status, ledger, normalise_stream, normalised, sweep

__all__ = ["handled_status", "ledger", "normalise_stream", "normalised", "sweep"]
