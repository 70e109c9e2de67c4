"""Reading tables, staging them, and writing results."""
