"""Continuous forms of the batch loads."""
