"""textloom: document collections on Spark, from mixed files to ranked answers."""

__version__ = "0.1.0"
