"""Structured Streaming forms of the report (S14, ST1-ST7)."""
