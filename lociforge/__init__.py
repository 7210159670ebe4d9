"""lociforge: a Spark-first engine for targeted long-read variant analytics."""
