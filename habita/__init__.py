"""habita: a Spark-native property-listings pipeline.

Raw pages, nested API documents and JSON wire messages become one typed
listing table using DataFrame, SQL and Structured Streaming operators only.
Every public function takes and returns DataFrames (or starts a streaming
query); nothing is collected to the driver.
"""

__version__ = "0.1.0"
