"""Incremental loads: high-water mark batches and file bookmarks."""
