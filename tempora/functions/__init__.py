"""Scalar Column builders. All run inside the JVM (no Python UDFs)."""

from tempora.functions.jsonops import clean_column_names, clean_name, decode_json, encode_json, flatten_struct
from tempora.functions.scalar import (
    even_timestamp,
    gaussian_noise,
    int_div,
    kelvin_to_celsius,
    linspace_value,
    split_pair,
    truncate_int,
    two_decimals,
    two_decimals_text,
)
from tempora.functions.timebuckets import (
    bucket_start,
    drop_name_time,
    epoch_micros,
    epoch_seconds,
    floor_to_width,
    minus_interval,
    parse_time_epoch,
    parse_time_text,
    plus_seconds,
    seconds_to_ts,
    ts_bucket_start,
)

__all__ = [
    "bucket_start", "clean_column_names", "clean_name", "decode_json", "drop_name_time", "encode_json",
    "epoch_micros", "epoch_seconds", "even_timestamp", "flatten_struct", "floor_to_width", "gaussian_noise",
    "int_div", "kelvin_to_celsius", "linspace_value", "minus_interval", "parse_time_epoch", "parse_time_text",
    "plus_seconds", "seconds_to_ts", "split_pair", "truncate_int", "ts_bucket_start", "two_decimals",
    "two_decimals_text",
]
