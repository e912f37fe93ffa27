"""Property graphs kept as ordinary Spark tables: one per vertex label, one per edge label."""

from graphtables.model import EdgeWrite, Label, Space, VertexWrite

__all__ = ["EdgeWrite", "Label", "Space", "VertexWrite"]
