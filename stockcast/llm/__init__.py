"""Training-data operators: packing, search, language ID, deduplication, tokens, chat, WARC.

Each module holds one operator; ``queries`` registers the ten ``opN_`` queries.
Nothing else in the library imports this subpackage.
"""
