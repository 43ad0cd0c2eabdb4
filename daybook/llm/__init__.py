"""Training-data operators (language id, dedup, packing, quality, ...).

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
registers its queries when the folder is there.
"""
