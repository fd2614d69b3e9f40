"""Structured Streaming jobs: landing, windowed revenue, duplicate suppression."""
