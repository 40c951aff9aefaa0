"""Features, random forests and their evaluation with Spark ML."""
