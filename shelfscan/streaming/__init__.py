"""The incremental load as a stream."""

from shelfscan.streaming.incremental import stream_into_raw

__all__ = ["stream_into_raw"]
