"""Layer schemas, the trip preset, and the jobs that run it."""
