"""Files in."""
