from .raw import parse, read_files, read_kafka
from .tables import clicks, events, raw_records, views

__all__ = ["clicks", "events", "parse", "raw_records", "read_files", "read_kafka", "views"]
