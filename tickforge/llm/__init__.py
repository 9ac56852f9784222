"""Operators for preparing training text: fingerprints, de-duplication,
decontamination, packing, language, secret and URL filters.

Nothing outside this subpackage imports it.
"""
