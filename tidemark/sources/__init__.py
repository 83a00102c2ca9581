"""Readers and writers."""

from tidemark.sources.documents import explode_items, found_schema, item_fields, parse_documents, read_category_items, read_documents
from tidemark.sources.files import (
    flatten_categories,
    read_categories,
    read_table,
    read_transactions,
    read_tweets,
    read_videos,
    write_csv,
    write_table,
)
from tidemark.sources.messages import message_reader, message_writer
from tidemark.sources.tables import categories, messages, table, transactions, tweets, videos

__all__ = [
    "categories",
    "explode_items",
    "flatten_categories",
    "found_schema",
    "item_fields",
    "message_reader",
    "message_writer",
    "messages",
    "parse_documents",
    "read_categories",
    "read_category_items",
    "read_documents",
    "read_table",
    "read_transactions",
    "read_tweets",
    "read_videos",
    "table",
    "transactions",
    "tweets",
    "videos",
    "write_csv",
    "write_table",
]
