"""Operators for training-data corpora: sharding, packing, segmentation, joins, scans, archives, filters and search."""
