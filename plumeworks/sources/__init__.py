"""Readers for the landed feeds and writers for the result tables."""
