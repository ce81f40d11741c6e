"""Training-data operators: extraction, filtering, deduplication, mixing, packing.

Nothing else in the library imports this subpackage; it only uses PySpark,
numpy, pyarrow and the codecs named in the README.
"""
