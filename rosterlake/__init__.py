"""rosterlake: directory and roster data processing on PySpark."""

__version__ = "0.1.0"
