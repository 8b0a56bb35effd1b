"""Operators for training data built from text and names. Nothing outside this subpackage imports it."""
