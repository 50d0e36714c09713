"""DataFrame -> DataFrame operators (silver, detection, gold, serving)."""
