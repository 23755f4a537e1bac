"""Readers and writers: feed pages, files, releases and catalog summaries."""
