"""Readers, table storage, watermarks and schemas."""
