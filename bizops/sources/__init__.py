"""Reading input tables and publishing results."""
