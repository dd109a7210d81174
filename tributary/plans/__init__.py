"""Bronze to silver, silver to gold, and the full refresh."""
