"""Readers: the evidence table, landed feeds, files, ground-truth folders, tweets."""
