"""The same work on streams."""
