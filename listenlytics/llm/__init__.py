"""Operators for preparing training text: filters, extraction, scores, joins and tokens.

Every operator takes a frame and the names of its key and text columns, reads only those
columns (others may have any name), and keeps one result row for each input row unless its
docstring says otherwise.
"""
