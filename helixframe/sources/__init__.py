"""Readers and writers of the text formats used for sequencing data."""
