"""Readers and writers: JSON feeds, day snapshots, HTML rows, search documents."""
