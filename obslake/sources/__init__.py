"""Readers for topics, file trees and tables."""
from obslake.sources.files import list_data_files, read_external_ndjson, read_external_table, read_log_text
from obslake.sources.tables import read_aggregates, read_service_metadata
from obslake.sources.topics import read_topic, read_topic_bytes, read_user_events

__all__ = [
    "list_data_files", "read_aggregates", "read_external_ndjson", "read_external_table", "read_log_text",
    "read_service_metadata", "read_topic", "read_topic_bytes", "read_user_events",
]
