"""Streams of new documents."""
