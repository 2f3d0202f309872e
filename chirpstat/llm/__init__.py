"""Training-data operators: ten dealt operators over documents, pages and labels.

Nothing else in the library imports this subpackage; `__spark_entry__.py` adds
its queries when the subpackage is present.
"""
