"""Operators composed into the stored tables of the platform."""
