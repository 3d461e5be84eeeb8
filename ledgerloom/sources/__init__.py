"""Readers and writers: landed CSV batches, the raw layer, layer tables, reports."""
