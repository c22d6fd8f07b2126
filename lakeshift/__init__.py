"""lakeshift: move relational tables into a lake and keep them current, on Spark.

Modules are plain ``DataFrame -> DataFrame`` functions plus a few writers; none
creates its own SparkSession and none holds credentials.
"""

__version__ = "0.1.0"
