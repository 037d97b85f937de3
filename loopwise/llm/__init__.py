"""Operators for building training corpora.

Nothing else in the package imports this subpackage; ``__spark_entry__`` adds
its queries when the subpackage can be imported.
"""
