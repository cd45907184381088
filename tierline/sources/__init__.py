"""Scans and the shaping of landed response documents."""
