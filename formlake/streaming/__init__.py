"""Structured Streaming drivers. The analytics have no streaming semantics of their own
(no event-time windows or state); the stream only decides which filing days to
(re)build as new filing texts land."""

from formlake.streaming.daily import start_filings_stream

__all__ = ["start_filings_stream"]
