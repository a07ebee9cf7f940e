from .feed import flatten_batches, parse_feed, read_feed
from .sinks import dead_letter_records, publish_dead_letters
from .tables import read_tables

__all__ = ["dead_letter_records", "flatten_batches", "parse_feed", "publish_dead_letters", "read_feed", "read_tables"]
