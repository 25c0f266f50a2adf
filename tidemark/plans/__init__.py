"""Tables out."""
