"""Registered queries and the domain views they read."""
