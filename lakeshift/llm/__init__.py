"""Training-data operators: tokenising, packing, language id, deduplication,
extraction, fingerprints, personal data, quality rules and LM scoring.

Nothing else in the library imports this subpackage.
"""
