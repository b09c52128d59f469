from .money import (exact_avg, money_sum, money_sum_dec, notional,  # noqa: F401
                    round_half_up)
from .signs import (cashflow_signed, long_part, position_side,  # noqa: F401
                    position_signed, short_part)
from .timefmt import (EVENT_TIME_PATTERN, FUTURE_CUTOFF,  # noqa: F401
                      format_event_time, hour_bucket, parse_event_time,
                      with_event_time)
