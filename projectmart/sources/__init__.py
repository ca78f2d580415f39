"""Schemas, table input and output, and the derived raw tables used by the tests."""
