"""Log import and tracking as Spark jobs: decode, project, key, roll, write and track."""

__version__ = "0.1.0"
