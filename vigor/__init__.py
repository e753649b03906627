"""vigor: Spark-native training-load and performance analytics.

Every operator is a plain function from DataFrame(s) to DataFrame built on the
public DataFrame API; pipelines compose them. See README.md for the layout.
"""

__version__ = "0.1.0"
