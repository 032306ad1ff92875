"""Operators for preparing training data: packing, decontamination, near duplicates,
chat formatting, licences, quality, token files, token counts and sharding.

Nothing else in the library imports this subpackage.
"""
