"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it; its queries are registered by
``__spark_entry__.py`` when it can be imported.
"""
