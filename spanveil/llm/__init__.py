"""Preparation of training text: packing, scans, classifiers, joins and search over whole corpora."""
