"""Readers for every form a reading takes."""
