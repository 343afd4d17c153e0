"""citeloom: literature curation (identifier resolution, merging, full text) as Spark DataFrame operators."""

__version__ = "0.1.0"
