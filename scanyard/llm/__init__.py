"""Operators for building training data from documents and web pages.

Nothing outside this subpackage imports it. ``queries`` registers one query per operator.
"""
