"""Incremental bronze to silver."""
