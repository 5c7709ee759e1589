"""registry_lens: package-registry history as typed Spark DataFrame transforms."""

__version__ = "0.1.0"
