"""Operators for preparing training text: packing, archives, duplicates, filters, mixing."""
