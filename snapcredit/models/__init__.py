"""Training, search, registry and scoring with Spark ML."""
