"""Scans: identifier lists, record JSON Lines, landed service responses, file bytes."""
