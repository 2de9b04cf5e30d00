"""Readers: paged API, rate documents, zones."""
