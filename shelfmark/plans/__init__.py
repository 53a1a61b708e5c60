"""The three jobs."""
