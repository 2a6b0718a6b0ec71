"""Where the tables and streams come from."""
