"""The batch jobs, each for all languages at once."""
