"""Training-data operators: tokens, quality, packing, de-duplication, chat, privacy, language.

Each module holds one operator with its own interface; ``queries`` binds them
to the tables of a folder and derives the digest columns of each query.
"""
