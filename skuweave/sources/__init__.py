"""Readers of the file formats that product data comes in, and writers of results."""
