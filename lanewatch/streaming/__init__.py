"""Event-time windows and running streams."""
