"""fieldloom: a Spark-native engine that turns crawled pages and documents into
ranked, normalised, deduplicated field tables.

Every public operator is a ``DataFrame -> DataFrame`` or ``Column -> Column``
function built from Spark SQL expressions, so batch and Structured Streaming
share one code path and Catalyst plans the whole job.
"""

__version__ = "0.1.0"
