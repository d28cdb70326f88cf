"""Operators for text corpora and language-model data. Nothing else in the package imports this subpackage."""
