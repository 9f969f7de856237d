"""Training-data operators: tokenising, repeats, near duplicates, filters.

Each module holds one operator with a general interface; ``queries`` turns
them into the registered ``opN_<name>`` digests.  Nothing outside this
subpackage imports it.
"""
