"""voxloom: a Spark-first engine for curating speech corpora."""

__version__ = "0.1.0"
