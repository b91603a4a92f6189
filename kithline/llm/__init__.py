"""Operators for preparing language-model training data at scale; nothing else in kithline imports this subpackage."""
