"""pyspark.ml stages, feature selection, tuning and model choice."""
