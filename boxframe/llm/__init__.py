"""Operators for training-data pipelines (language id, toxicity, quality, dedup, tokenising, ...).

Nothing else in the library imports this subpackage. ``queries.py`` holds the
registered ``opN_<name>`` queries; every operator module has its own general
interface and documents what it does with nulls, empty texts, ties and
repeated rows.
"""
