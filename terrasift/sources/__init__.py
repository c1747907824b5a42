"""Readers and writers for tables, predictions and image folders."""
