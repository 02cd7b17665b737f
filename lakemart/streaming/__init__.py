"""Incremental runs of the line de-duplication and of the notice cards."""
