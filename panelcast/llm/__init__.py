"""Operators for preparing text corpora at scale; nothing outside this folder imports it."""
