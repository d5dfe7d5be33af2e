"""Readers and writers: subject XML, label lines, views, staged tables."""
