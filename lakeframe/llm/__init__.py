"""Operators for building language-model training corpora, one module per operator.

Nothing outside this package (but the optional hook in ``__spark_entry__``) imports it.
"""
