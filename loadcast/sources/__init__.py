"""Sources of sensor readings."""

from .sensor import (SENSOR, SENSOR_COLUMNS, complete, decode_kafka, from_events,
                     load_sensor, parse_lines, read_csv, read_csv_stream, read_kafka,
                     read_parquet, read_text, rebase_event_time, sensor_from_testdata,
                     with_event_time)

__all__ = ["SENSOR", "SENSOR_COLUMNS", "complete", "decode_kafka", "from_events",
           "load_sensor", "parse_lines", "read_csv", "read_csv_stream", "read_kafka",
           "read_parquet", "read_text", "rebase_event_time", "sensor_from_testdata",
           "with_event_time"]
