"""Distributed operators: sessions, labels, statistics, JSON."""
