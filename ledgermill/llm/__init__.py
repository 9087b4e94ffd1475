"""Operators for preparing training text: ten methods, their queries, and shared kernels."""
