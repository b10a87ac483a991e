"""Relational, statistical, learning, text, graph and clustering operators."""
