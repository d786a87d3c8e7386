"""Operators for preparing training data: sharding, quality, deduplication, language, personal data,
nearest neighbours, tokens and packing. Nothing else in the library imports this subpackage."""
