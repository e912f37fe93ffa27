"""Label tables as streams, and streams as mutations."""

from graphtables.streaming.sink import latest_changes, mutate_from_stream
from graphtables.streaming.source import stream_changes, stream_edges, stream_vertices

__all__ = ["latest_changes", "mutate_from_stream", "stream_changes", "stream_edges", "stream_vertices"]
