"""Operators for preparing large text corpora, and their registered queries."""
