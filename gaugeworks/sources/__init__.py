"""Readers and writers: CSV batches, versioned tables, audit logs."""
