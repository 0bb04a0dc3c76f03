"""Operators for preparing training text: filtering, de-duplication, tokens, packing and sharding."""
