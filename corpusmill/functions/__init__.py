"""Part of corpusmill."""
