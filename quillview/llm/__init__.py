"""Operators for preparing training data; nothing else in quillview imports them."""
