"""Operators for preparing training text: each module builds one of them."""
