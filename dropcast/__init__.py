"""dropcast: delivery-time (ETA) analytics on Spark.

DataFrame expressions, ``pyspark.ml`` stages, batch jobs and Structured
Streaming jobs for cleaning, feature engineering, training, scoring,
evaluation and drift monitoring of delivery orders.
"""

__version__ = "0.1.0"
