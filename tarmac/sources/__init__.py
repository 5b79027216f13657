"""Readers and writers. Every path may be any URI that Spark can open."""
