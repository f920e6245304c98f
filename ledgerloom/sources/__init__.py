"""Readers: declared tables, click objects, score queries and prefix listings."""
