"""Operators on texts for language models. Nothing else in the package imports this one."""
