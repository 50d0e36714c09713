from .scalar import confidence, event_key, safe_div, to_event_time

__all__ = ["confidence", "event_key", "safe_div", "to_event_time"]
