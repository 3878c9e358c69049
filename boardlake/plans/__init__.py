"""Plans: the pipeline jobs and the stand-in queries over the driver tables."""
