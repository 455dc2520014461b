"""The raw layer fed by a stream."""
from dimflow.streaming.upsert import upsert_stream

__all__ = ["upsert_stream"]
