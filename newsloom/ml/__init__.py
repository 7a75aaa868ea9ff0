"""Features, selection, classifiers, evaluation and scoring on ``pyspark.ml``."""
