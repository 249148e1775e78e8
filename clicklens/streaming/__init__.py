"""Structured Streaming wiring of the ad-click jobs."""
