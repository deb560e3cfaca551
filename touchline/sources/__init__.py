"""Where data is read from and written to."""
