"""fieldspark: a Spark-first engine for play-by-play analytics and training-data pipelines."""
