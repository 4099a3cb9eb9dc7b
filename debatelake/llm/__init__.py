"""Operators for preparing training corpora: filters, scans, fingerprints, joins, codecs and sharding.

Nothing outside this subpackage imports it.
"""
