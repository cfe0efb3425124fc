"""Composed jobs: the public entry points that chain operators, readers and writers."""
