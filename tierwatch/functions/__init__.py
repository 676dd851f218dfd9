"""Column functions and the two Python plug-in points (embedder, completer)."""
