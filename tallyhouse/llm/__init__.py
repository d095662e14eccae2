"""Training-data operators: tokenizing, scoring, de-duplication, search.

Nothing outside this subpackage imports it. General helpers (checkpoint
folder, size estimates) come from the library; every operator module has
a general interface, and ``queries`` holds the thin registered queries.
"""
