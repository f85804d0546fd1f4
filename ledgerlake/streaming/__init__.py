from ledgerlake.streaming.changes import append_stream, dedup_stream, sync_stream
from ledgerlake.streaming.late import mark_late, timed_state

__all__ = ["append_stream", "dedup_stream", "mark_late", "sync_stream", "timed_state"]
