from sessionloom.functions.expressions import (
    minutes_between,
    order_flag,
    parse_timestamp,
    span_micros,
    whole_minutes,
)

__all__ = ["minutes_between", "order_flag", "parse_timestamp", "span_micros", "whole_minutes"]
