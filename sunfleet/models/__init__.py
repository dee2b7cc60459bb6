"""Training, evaluation, storage and scoring with Spark ML."""
