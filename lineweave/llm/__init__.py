"""Operators of a training-data pipeline: media columns, mixing, shards, near duplicates, tokens, chats, search and filters."""
