"""Operators for training-data corpora (duplicates, search, packing,
personal data, tokenising, classifiers), each a Spark job over whole
tables.  Nothing else in the library imports this subpackage."""
