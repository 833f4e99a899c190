"""Audio-link mining over web-crawl data, written for Spark DataFrames."""

__version__ = "0.1.0"
