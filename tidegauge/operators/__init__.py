"""Operators: ``DataFrame -> DataFrame``, the same for tables and streams unless noted."""
