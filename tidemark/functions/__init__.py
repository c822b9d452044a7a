from .parsing import bad_timestamp, lenient_timestamp, unknown_fields

__all__ = ["bad_timestamp", "lenient_timestamp", "unknown_fields"]
