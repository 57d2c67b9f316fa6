"""Readers and writers: topics, files, databases, dimension tables, upsert and metric tables."""
