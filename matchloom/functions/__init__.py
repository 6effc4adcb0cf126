"""Column functions for names, addresses, scripts and sounds."""
