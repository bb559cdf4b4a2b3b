"""Structured Streaming signal windows and live anomaly flags."""
