"""Imports every module that registers queries."""

from quillview.plans import catalogs, documents, logs, served  # noqa: F401
