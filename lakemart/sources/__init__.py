"""Readers and writers: till files, master tables, the partitioned lake."""
