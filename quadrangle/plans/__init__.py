"""The jobs: each module has the transformation and the run that reads and writes."""
