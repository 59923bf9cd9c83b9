"""Streaming: intentionally empty.

The analytics being rebuilt are a scheduled batch over closed periods; they have no
watermark, window, state or late-data logic. Late data is handled by re-running the
period, which the versioned period store (``callgrid.sinks.store``) makes idempotent.
"""
