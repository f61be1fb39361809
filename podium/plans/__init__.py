"""Jobs and the registry of verification queries over the driver tables."""
