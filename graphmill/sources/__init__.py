"""Readers and writers of edge-list, weighted edge-list and ego-net files."""
