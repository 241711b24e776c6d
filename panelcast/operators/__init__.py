"""Operators over a long panel.  Each is a function DataFrame -> DataFrame."""
