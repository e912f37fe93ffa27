"""Reading label tables, profiling them, and keeping them on disk."""
