"""Readers and writers: text and table formats, indexed token stores, tar shards."""
