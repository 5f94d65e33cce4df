"""Operators for preparing training data: token counts and packing, near-duplicate
and nearest-neighbour search, quality and toxicity scores, mixing and licences.

Nothing outside this subpackage imports it.
"""
