"""Models that put a stress class on rows of the six features."""
