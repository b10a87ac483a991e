"""Typed table loaders, derived views, file readers and sinks."""
