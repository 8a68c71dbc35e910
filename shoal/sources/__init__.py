"""Readers: topics (and their file form), JDBC tables, configuration change
records, delimited text, and the input shapes derived from the test tables."""
