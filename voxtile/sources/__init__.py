"""Readers and writers of the table, label and metadata formats."""
