"""Ways to get samples, file listings and messages."""
