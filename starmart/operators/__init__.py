"""Relational building blocks, generic over tables and keys."""
