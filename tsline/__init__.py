"""tsline: Spark-native encoding, decoding, packing and delivery of time-series lines.

The most used entry points, re-exported::

    from tsline import encode_lines, decode_lines, decode_columns, pack_by_count, send_lines
"""

from tsline.operators.changelog import changelog_filter, upsert_latest
from tsline.operators.custom import arrow_line_encoder, encode_custom, points_from
from tsline.operators.decode import decode_columns, decode_lines, pivot_points
from tsline.operators.encode import encode_lines
from tsline.operators.explore import (count_fields, count_points, delete_by_time, field_keys,
                                      filter_tag, latest_n, measurements, points_per_interval,
                                      series_index, tag_keys)
from tsline.operators.pack import pack_by_count, pack_by_interval, payloads, route
from tsline.operators.points import encode, points_to_lines, to_points
from tsline.operators.windows import tumble_agg, tumble_lines
from tsline.session import get_session
from tsline.sources.delivery import (read_payload_lines, read_write_log, register, send_lines,
                                     write_stats)
from tsline.sources.lines import read_back, scan_points, write_lines

__version__ = "0.1.0"

__all__ = [
    "arrow_line_encoder", "changelog_filter", "count_fields", "count_points", "decode_columns",
    "decode_lines", "delete_by_time", "encode", "encode_custom", "encode_lines", "field_keys",
    "filter_tag", "get_session", "latest_n", "measurements", "pack_by_count", "pack_by_interval",
    "payloads", "pivot_points", "points_from", "points_per_interval", "points_to_lines",
    "read_back", "read_payload_lines", "read_write_log", "register", "route", "scan_points",
    "send_lines", "series_index", "tag_keys", "to_points", "tumble_agg", "tumble_lines",
    "upsert_latest",
    "write_lines", "write_stats",
]
