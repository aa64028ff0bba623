"""Batched checks, declared tests and the gates built on them."""
