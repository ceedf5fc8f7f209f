"""Time patterns such as ``${yyyyMMdd-1d}`` in names, paths and query parameters.

Times are ``yyyyMMddHHmm`` text, as in the interface records. Every function
takes columns, so patterns may differ per row; plain strings work as well.
An unknown pattern or unit fails the job with a clear message.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import zip_longest

from pyspark.sql import Column
from pyspark.sql import functions as F

CLOCK = "yyyyMMddHHmm"
TOKEN = r"\$\{.*?\}"
_OFFSET = r"([+-]\d+)([ydHMm])"

# Token to date format.
TOKEN_FORMATS = {
    "${yyyy}": "yyyy",
    "${MM}": "MM",
    "${dd}": "dd",
    "${HH}": "HH",
    "${yyyyMM}": "yyyyMM",
    "${yyyyMMdd}": "yyyyMMdd",
    "${yyyyMMddHH}": "yyyyMMddHH",
    "${yyyyMMdd_HH}": "yyyyMMdd_HH",
    "${yyyyMMdd HH}": "yyyyMMddHH",
    "${yyyyMMdd_HHmm}": "yyyyMMdd_HHmm",
    "${yyyyMMdd HHmm}": "yyyyMMddHHmm",
    "${yyyyMMddHHmm}": "yyyyMMddHHmm",
    "${yyyyMM}01": "yyyyMM'01'",
    "${yyMMddHH}": "yyMMddHH",
    "${HHmm}": "HHmm",
}

# Offset unit to output format of a query parameter.
UNIT_FORMATS = {"y": "yyyy", "M": "yyyyMM", "d": "yyyyMMdd", "H": "yyyyMMddHH", "m": "yyyyMMddHHmm"}

# Collection cycle to date format.
CYCLE_FORMATS = {"MI": "yyyyMMddHHmm", "HH": "yyyyMMddHH", "DD": "yyyyMMdd", "MM": "yyyyMM", "WW": "yyyyMMdd"}

# Length of a time text to its format.
LENGTH_FORMATS = {4: "yyyy", 6: "yyyyMM", 8: "yyyyMMdd", 10: "yyyyMMddHH", 12: "yyyyMMddHHmm"}

# Pattern in a file name to the number of leading time digits it
# stands for; the first that occurs in the pattern counts.
LEADING_DIGITS = {
    "yyyyMMddhhmm": 12,
    "yyyyMMddHH": 10,
    "yyyyMMddhh": 10,
    "yyyyMMdd": 8,
    "yyyyMM": 6,
    "yyMMddHH": 8,
    "\\d{12}": 12,
    "\\d{10}": 10,
    "\\d{8}": 8,
    "\\d{6}": 6,
}


def as_col(value: Column | str) -> Column:
    """A column as it is; text as a literal."""
    return value if isinstance(value, Column) else F.lit(value)


def _fail(message: str, detail: Column) -> Column:
    return F.raise_error(F.concat(F.lit(message + ": "), detail)).cast("string")


def bind(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build(value)`` with the value worked out once, however often ``build`` uses it."""
    return F.get(F.transform(F.array(value), build), F.lit(0))


def _formatted(ts: Column, key: Column, formats: dict[str, str], otherwise: Column) -> Column:
    """``ts`` in the format that ``key`` stands for; each branch has a constant format."""

    def branches(pair: Column) -> Column:
        chosen = otherwise
        for name, form in reversed(formats.items()):
            chosen = F.when(pair["k"] == name, F.date_format(pair["t"], form)).otherwise(chosen)
        return chosen

    return bind(F.struct(key.alias("k"), ts.alias("t")), branches)


def _choose(key: Column, options: dict, otherwise: Column) -> Column:
    """``options[key]``, by a constant map."""
    pairs = [F.lit(item) for pair in options.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), otherwise)


def parse_clock(time: Column | str) -> Column:
    return F.to_timestamp(as_col(time), CLOCK)


def parse_by_length(time: Column | str) -> Column:
    """Timestamp of 6, 8, 10 or 12 digits; any other length fails."""
    text = as_col(time)
    known = {n: f for n, f in LENGTH_FORMATS.items() if n >= 6}
    padded = F.when(F.length(text) == 6, F.concat(text, F.lit("01"))).otherwise(text)
    filled = F.rpad(padded, 12, "0")
    return F.when(F.length(text).isin(*known), F.to_timestamp(filled, CLOCK)).otherwise(
        _fail("time has an unexpected length", text).cast("timestamp")
    )


def find_patterns(text: Column | str) -> Column:
    return F.regexp_extract_all(as_col(text), F.lit(TOKEN), F.lit(0))


# Offset unit to the field of an interval it counts.
_MONTHS = {"y": 12, "M": 1}
_DAYS = {"d": 1}
_MINUTES = {"H": 60, "m": 1}


def shift(ts: Column, number: Column, unit: Column) -> Column:
    """Move a timestamp by ``number`` units of y, M, d, H or m; month ends are clipped.

    Another unit, or no number, moves nothing.
    """

    def of(factors: dict[str, int]) -> Column:
        return F.coalesce(number * _choose(unit, factors, F.lit(0)), F.lit(0))

    return ts + F.make_interval(F.lit(0), of(_MONTHS), F.lit(0), of(_DAYS), F.lit(0), of(_MINUTES), F.lit(0))


def format_token(token: Column | str, ts: Column) -> Column:
    token = as_col(token)
    return _formatted(ts, token, TOKEN_FORMATS, _fail("unknown time pattern", token))


def strip_offset(pattern: Column | str) -> Column:
    return F.regexp_replace(as_col(pattern), _OFFSET, "")


def shifted_by_pattern(pattern: Column | str, ts: Column) -> Column:
    """``ts`` moved by the first offset a pattern carries, if any."""
    pattern = as_col(pattern)
    number = F.regexp_extract(pattern, _OFFSET, 1).try_cast("int")
    return shift(ts, number, F.regexp_extract(pattern, _OFFSET, 2))


def _constant(pattern: str, clock: Column) -> Column:
    """A pattern known when the plan is made: plain date arithmetic and one constant format."""
    base = re.sub(_OFFSET, "", pattern)
    if base not in TOKEN_FORMATS:
        raise ValueError(f"unknown time pattern: {pattern}")
    return F.date_format(_moved_by_constant(pattern, clock), TOKEN_FORMATS[base])


def _moved_by_constant(pattern: str, clock: Column) -> Column:
    offset = re.search(_OFFSET, pattern)
    if offset is None:
        return clock
    number, unit = int(offset[1]), offset[2]
    zero = F.lit(0)
    months, days, minutes = (F.lit(number * factors.get(unit, 0)) for factors in (_MONTHS, _DAYS, _MINUTES))
    return clock + F.make_interval(zero, months, zero, days, zero, minutes, zero)


def _constant_pieces(text: str, resolve: Callable[[str], Column]) -> tuple[Column, list[str]]:
    """A text with its patterns resolved, and the patterns."""
    tokens = re.findall(TOKEN, text)
    pieces: list[Column] = []
    for plain, token in zip_longest(re.split(TOKEN, text), tokens):
        pieces.append(F.lit(plain))
        if token is not None:
            pieces.append(resolve(token))
    return F.concat(*pieces), tokens


def resolve_pattern(pattern: Column | str, start: Column | str) -> Column:
    """One pattern with an optional offset, formatted: ``${yyyyMMddHH-30m}``."""
    if isinstance(pattern, str):
        return _constant(pattern, parse_clock(start))
    return format_token(strip_offset(pattern), shifted_by_pattern(pattern, parse_clock(start)))


def expand_path(path: Column | str, start: Column | str) -> Column:
    """All patterns of a path resolved; ``target_time`` joins the resolved parts.

    Without any pattern ``target_time`` is the start time.
    """
    start = as_col(start)
    if isinstance(path, str):
        clock = parse_clock(start)
        done, found = _constant_pieces(path, lambda token: _constant(token, clock))
        parts = F.concat(*[_constant(token, clock) for token in found]) if found else start
        return F.struct(done.alias("path"), parts.alias("target_time"))
    resolved = F.transform(
        find_patterns(path), lambda token: F.struct(token.alias("token"), resolve_pattern(token, start).alias("text"))
    )

    def filled(parts: Column) -> Column:
        return F.struct(
            F.aggregate(parts, path, lambda text, part: F.replace(text, part["token"], part["text"])).alias("path"),
            F.when(F.size(parts) > 0, F.array_join(parts["text"], "")).otherwise(start).alias("target_time"),
        )

    return bind(resolved, filled)


def _digits_token(token: Column) -> Column:
    return token.rlike(r"^\\d\{\d+\}$")


def _resolve_in_name(token: Column, start: Column, clock: Column) -> Column:
    """One name pattern: a ``\\d{n}`` pattern takes the leading digits of the time."""
    lengths = {"\\d{12}": 12, "\\d{10}": 10, "\\d{8}": 8, "\\d{6}": 6}
    length = _choose(token, lengths, F.raise_error(F.concat(F.lit("unknown digit pattern: "), token)).cast("int"))
    resolved = format_token(strip_offset(token), shifted_by_pattern(token, clock))
    return F.when(_digits_token(token), F.left(start, length)).otherwise(resolved)


def resolve_name(
    name: Column | str,
    start: Column | str,
    target: Column | str | None = None,
    tokens: Column | None = None,
) -> Column:
    """Patterns of a file name replaced, as a struct of ``name`` and ``target_time``.

    An explicit target time overrides the offsets. Otherwise ``target_time`` is
    the start time moved by the offset of the last pattern. ``tokens`` is the list of
    patterns to replace; by default the ``${...}`` ones found in the name.
    """
    start = as_col(start)
    if isinstance(name, str) and tokens is None and target is None:
        clock = parse_clock(start)
        done, found = _constant_pieces(name, lambda token: _constant(token, clock))
        moved = F.date_format(_moved_by_constant(found[-1], clock), CLOCK) if found else start
        return F.struct(done.alias("name"), moved.alias("target_time"))
    name = as_col(name)
    tokens = find_patterns(name) if tokens is None else tokens

    def by_start(found: Column) -> Column:
        last = F.try_element_at(found["tokens"], F.lit(-1))
        moved = F.when(_digits_token(last), found["clock"]).otherwise(shifted_by_pattern(last, found["clock"]))
        return F.struct(
            F.aggregate(
                found["tokens"], name, lambda text, token: F.replace(text, token, _resolve_in_name(token, start, found["clock"]))
            ).alias("name"),
            F.coalesce(F.date_format(moved, CLOCK), start).alias("target_time"),
        )

    by_offset = bind(F.struct(tokens.alias("tokens"), parse_clock(start).alias("clock")), by_start)
    if target is None:
        return by_offset
    target = as_col(target)

    def by_target(text: Column, token: Column) -> Column:
        return F.replace(text, token, format_token(strip_offset(token), parse_clock(target)))

    return F.when(
        target.isNotNull(), F.struct(F.aggregate(tokens, name, by_target).alias("name"), target.alias("target_time"))
    ).otherwise(by_offset)


def move_clock(pattern: Column | str, start: Column | str, operator: Column | str) -> Column:
    """``30m`` added to or taken from a time; the unit sets the output format."""
    pattern, operator = as_col(pattern), as_col(operator)
    number = F.regexp_extract(pattern, r"(\d+)", 1).cast("int")
    unit = F.regexp_extract(pattern, r"([a-zA-Z])", 1)
    signed = (
        F.when(operator == "+", number)
        .when(operator == "-", -number)
        .otherwise(F.raise_error(F.concat(F.lit("unknown operator: "), operator)).cast("int"))
    )
    last = F.right(pattern, F.lit(1))
    return _formatted(shift(parse_clock(start), signed, unit), last, UNIT_FORMATS, _fail("unknown time unit", pattern))


def resolve_parameter(param: Column | str, start: Column | str) -> Column:
    """A query parameter: literal, ``${yyyyMMdd}``, or ``${yyyyMMdd-1H}`` (granularity of the unit)."""
    param = as_col(param)
    calculated = param.contains("-") | param.contains("+")
    amount = F.regexp_extract(param, r"(\d+\w)", 1)
    operator = F.when(param.contains("-"), "-").otherwise("+")
    return (
        F.when(~param.contains("${"), param)
        .when(calculated, move_clock(amount, start, operator))
        .otherwise(format_token(param, parse_clock(start)))
    )


def cycle_time(cycle: Column | str, ts: Column) -> Column:
    cycle = as_col(cycle)
    return _formatted(ts, cycle, CYCLE_FORMATS, _fail("unknown cycle", cycle))


def cycle_of_length(target_time: Column, cycle: Column | str) -> Column:
    """On demand (``OD``) the cycle follows from the length of the target time."""
    cycle = as_col(cycle)
    size = F.length(target_time)
    return F.when(
        cycle == "OD", F.when(size == 6, "MM").when(size == 8, "DD").when(size >= 10, "HH")
    ).otherwise(cycle)


def partition_values(target_time: Column | str, cycle: Column | str) -> Column:
    """Struct ``dt``, ``hh``, ``hm`` of a target time: hours for HH, minutes for MI."""
    cycle = as_col(cycle)
    full = cycle_time(cycle, parse_by_length(target_time))
    return F.struct(
        F.left(full, F.lit(8)).alias("dt"),
        F.when(cycle == "HH", F.substring(full, 9, 2)).alias("hh"),
        F.when(cycle == "MI", F.substring(full, 9, 4)).alias("hm"),
    )


def name_by_source_date(src_dt: Column | str, name: Column | str) -> Column:
    """Patterns of a delivery file name replaced by the leading digits of the source date."""
    src_dt, name = as_col(src_dt), as_col(name)
    pattern = r"\$\{.*?\}|\\d\{(6|8|10|12)\}"
    found = F.regexp_extract(name, pattern, 0)
    digits = F.lit(0)
    for part, length in reversed(LEADING_DIGITS.items()):
        digits = F.when(found.contains(part), length).otherwise(digits)
    return F.when(found == "", name).otherwise(F.regexp_replace(name, F.lit(pattern), F.left(src_dt, digits)))


def path_by_source_date(src_dt: Column | str, path: Column | str) -> Column:
    """Patterns of a delivery path formatted with a source date of 4 to 12 digits; minus offsets are cut."""
    src_dt, path = as_col(src_dt), as_col(path)
    padded = F.concat(src_dt, F.substring(F.lit("000001010000"), F.length(src_dt) + 1, F.lit(12)))
    ts = F.when(F.length(src_dt).isin(*LENGTH_FORMATS), F.to_timestamp(padded, CLOCK)).otherwise(
        _fail("time has an unexpected length", src_dt).cast("timestamp")
    )
    tokens = F.regexp_extract_all(path, F.lit(r"\$\{[a-zA-Z0-9_\-]+\}"), F.lit(0))
    return F.aggregate(
        tokens,
        path,
        lambda text, token: F.replace(text, token, format_token(F.regexp_replace(token, r"-\d+[dMhH]", ""), ts)),
    )


def pad_start_time(time: Column) -> Column:
    """A start time of 8 or 10 digits filled up to 12."""
    return F.when(F.length(time).isin(8, 10), F.rpad(time, 12, "0")).otherwise(time)
