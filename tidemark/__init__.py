"""Tidemark: batch files to trusted, historised tables, as DataFrame and SQL plans."""
