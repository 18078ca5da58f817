"""The engine's end-to-end jobs."""
