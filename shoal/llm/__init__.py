"""Training-data operators: de-duplication, scoring, sanitising, mixing, packing, encoding.

Nothing else in the package imports this subpackage.
"""
