"""Readers for the line formats and tables, with a rejects side output."""
