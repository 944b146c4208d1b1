"""Training-data operators: fingerprints, packing, extraction, dedup, scans.

Each module holds one operator; ``queries`` binds them to the given tables.
Nothing outside this package imports it, but for the guarded hook in the
driver's entry file.
"""
