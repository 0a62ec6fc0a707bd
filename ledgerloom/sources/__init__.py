"""Readers: tables, files, landed feeds and generated rows."""
