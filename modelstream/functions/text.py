"""Names, lines and rendered results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from modelstream.schemas import KIND_NAMES

# The layout of the statistics report and of a served-result line.
REPORT_FORMAT = "| %-50s | %-38s | %-19s | %8.5f | %3d | %3d |"
REPORT_HEADER = "| %-50s | %-38s | %-19s | %-8s | %-3s | %-3s |"
REPORT_TITLES = ("Name", "Description", "Since", "Average", "Min", "Max")
REPORT_WIDTHS = (50, 38, 19, 8, 3, 3)
RESULT_FORMAT = "Model served in %d ms, with result %s (model %s, data type %s)"
DATE_FORMAT = "yyyy/MM/dd HH:mm:ss"


def latency_ms(ts: Column, now_ms: Column | None = None) -> Column:
    """Milliseconds from `ts` to `now_ms`, by default the time the query runs."""
    now = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    return (now - ts).cast("bigint")


def stamp(now_ms: Column | None = None) -> Column:
    """The send time of a record as epoch milliseconds."""
    return F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms


def model_name(path: Column, suffix: str = "pmml") -> Column:
    """The file name at the end of `path` without its suffix."""
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), rf"\.{suffix}$", "")


def split_fields(line: Column, separator: str = ";") -> Column:
    """The trimmed fields of a delimited line."""
    return F.transform(F.split(line, separator), lambda field: F.trim(field))


def number(field: Column) -> Column:
    """The field as a double; a missing field or one that is no number fails the query."""
    wrong = F.raise_error(F.concat(F.lit("not a number: "), F.coalesce(field, F.lit("missing field"))))
    return F.coalesce(F.trim(field).try_cast("double"), wrong.cast("double"))


def parse_doubles(line: Column, width: int, separator: str = ";") -> list[Column]:
    """The first `width` fields of a delimited line as doubles."""
    fields = F.split(line, separator)
    return [number(F.get(fields, F.lit(i))) for i in range(width)]


def kind_name(kind: Column) -> Column:
    """The name of a model kind code; null for a code without one."""
    pairs = [F.lit(v) for item in KIND_NAMES.items() for v in item]
    return F.try_element_at(F.create_map(*pairs), kind)


def kind_code(name: Column) -> Column:
    """The code of a model kind name; null for an unknown name."""
    pairs = [F.lit(v) for code, text in KIND_NAMES.items() for v in (text, code)]
    return F.try_element_at(F.create_map(*pairs), name)


def payload_digest(payload: Column) -> Column:
    """Two models are equal when the digests of their payloads are."""
    return F.sha2(payload, 256)


def result_line(latency: Column, result: Column, name: Column, data_type: Column) -> Column:
    """One served result as a line of text."""
    return F.format_string(RESULT_FORMAT, latency, result.cast("string"), name, data_type)


def report_line(
    name: Column, description: Column, since: Column, average: Column, low: Column, high: Column
) -> Column:
    """One statistics row as a line of the report table."""
    when = F.date_format(F.timestamp_millis(since), DATE_FORMAT)
    return F.format_string(REPORT_FORMAT, name, description, when, average, low, high)


def report_header() -> list[str]:
    """The two lines above the report's rows."""
    return [REPORT_HEADER % REPORT_TITLES, REPORT_HEADER % tuple("-" * w for w in REPORT_WIDTHS)]
