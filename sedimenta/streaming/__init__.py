"""Landing folders as file streams."""

from sedimenta.streaming.landing import ingest_landing_stream, save_batch

__all__ = ["ingest_landing_stream", "save_batch"]
