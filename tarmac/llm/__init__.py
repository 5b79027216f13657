"""Operators on text and vectors for preparing training data, each usable alone; see the README."""
