"""Whole jobs: each function takes frames and returns a frame."""
