"""Streaming forms of landing, entity merging, daily counts and de-duplication."""
