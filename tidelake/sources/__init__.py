"""Readers: landed provider responses, historical dumps, and the lake itself."""
