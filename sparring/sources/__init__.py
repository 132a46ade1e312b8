"""Reading input tables and writing results."""
