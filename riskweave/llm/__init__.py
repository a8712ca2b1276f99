"""Operators for large training-data corpora: filtering, matching, masking, counting, packing."""
