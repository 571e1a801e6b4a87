"""Work lists for imports, and the reads the lake exists for."""
