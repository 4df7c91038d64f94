"""Training-data operators: fingerprints, scans, classifiers, joins, mixing and sharding.

Nothing else in the library imports this subpackage.
"""
