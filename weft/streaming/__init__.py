"""Streaming form of gap sessions."""
