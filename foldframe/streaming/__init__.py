"""Structured Streaming: nothing here by design.

The original processes folders that are complete before a job starts (no watermark, window,
state or late data), so there is no streaming operator to rebuild. A restartable batch job is
expressed with an anti join against finished outputs (see ``anti_join_processed``).
"""
