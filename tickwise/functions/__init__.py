from tickwise.functions.numeric import np_round, to_cents, safe_div
from tickwise.functions.timefns import epoch_ms, epoch_us, parse_event_time, event_date

__all__ = ["np_round", "to_cents", "safe_div", "epoch_ms", "epoch_us",
           "parse_event_time", "event_date"]
