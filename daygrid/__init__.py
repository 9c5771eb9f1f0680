"""Turns session schedules into aligned, display-ready calendar tables on Spark."""
