"""Spark operators over governed tables and over rule results."""
