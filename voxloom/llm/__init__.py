"""Operators for preparing language-model training data.  Nothing else in voxloom imports this subpackage."""
