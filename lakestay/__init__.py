"""Spark operators for a daily bookings lakehouse."""
