"""Values read from, or written into, file names and partition paths."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from quayside.config import CODEC_EXTENSIONS
from quayside.functions.timepat import as_col, bind

# Date runs cut from file names.
_DATE_RUN = r"(?:_|-)?\d{6,}(?:\d{2})?(?:[-_]?\d{4})?(?:_|-)?"
_DATE_AFTER_MARK = r"[^a-zA-Z0-9]+(\d{6,})"

# A calendar date of the years 19xx or 20xx with an optional HHmm.
_SOURCE_DATE = (
    r"((?:19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01]))"
    r"((?:[01][0-9]|2[0-3])?(?:[0-5][0-9]))?"
)

# Period mark in a path to its schedule.
PERIOD_SCHEDULES = {
    "period=1h": "0 * * * *",
    "period=1d": "0 0 * * *",
    "period=1w": "0 0 * * 4",
    "period=1m": "0 0 1-7 * 5",
}


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def full_extension(path: Column) -> Column:
    """From the first dot of a path on, or an empty string."""
    return F.regexp_extract(path, r"\..*$", 0)


def parent(path: Column) -> Column:
    return F.left(path, F.length(path) - F.length(base_name(path)) - 1)


def partition_value(path: Column, key: str, value: str = "[^/]+") -> Column:
    """Value of ``key=`` as a whole path segment, or null."""
    return F.nullif(F.regexp_extract(path, f"(?:^|/){key}=({value})", 1), F.lit(""))


def database_of(path: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(path, "(?:^|/)db=([^/]+)/tb=([^/]+)", 1)), F.lit(""))


def table_of(path: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(path, "(?:^|/)db=([^/]+)/tb=([^/]+)", 2)), F.lit(""))


def partitions_of(path: Column) -> Column:
    """Struct of dt, hh, hm, ym, nw, sys; a two-digit ``hh`` also gives ``hm``, unless the path has one."""
    hh = partition_value(path, "hh", r"\d+")
    hm = partition_value(path, "hm", r"\d+")
    return F.struct(
        partition_value(path, "dt", r"\d+").alias("dt"),
        hh.alias("hh"),
        F.coalesce(hm, F.when(F.length(hh) == 2, F.concat(hh, F.lit("00")))).alias("hm"),
        partition_value(path, "ym", r"\d{6}").alias("ym"),
        partition_value(path, "nw").alias("nw"),
        partition_value(path, "sys").alias("sys"),
    )


def partition_list(path: Column, keys: Sequence[str] = ("dt", "hh", "hm", "ym")) -> Column:
    """``[{key: value}, ...]`` of the partitions a path holds, in key order."""
    patterns = {"ym": r"\d{6}"}
    found = []
    for key in keys:
        value = partition_value(path, key, patterns.get(key, r"\d+"))
        found.append(F.when(value.isNotNull(), F.create_map(F.lit(key), value)))
    return F.array_compact(F.array(*found))


def joined_partition_values(parts: Column) -> Column:
    """All values of a partition list, concatenated in order."""
    return F.array_join(F.transform(parts, lambda part: F.array_join(F.map_values(part), "")), "")


def first_of_month(ym: Column) -> Column:
    """A six-digit month gets day 01; other values stay."""
    return F.when(ym.rlike(r"^\d{6}$"), F.concat(ym, F.lit("01"))).otherwise(ym)


def named_by_partitions(path: Column) -> Column:
    """``tb_dt_hh_hm`` of the partitions in a path."""
    return F.concat_ws("_", *[partition_value(path, key) for key in ("tb", "dt", "hh", "hm")])


def file_stem(path: Column, cycle: Column | str | None = None, target_time: Column | None = None) -> Column:
    """Name of a merged file: the stem of the file in the path, else ``tb_dt_hh_hm``.

    With an hourly or minute cycle, a missing hh or hm comes from the target
    time and follows ``dt`` (or stands last when there is no ``dt``).
    """
    base = base_name(path)
    values = {key: partition_value(path, key) for key in ("tb", "dt", "hh", "hm")}
    extra = F.lit(None).cast("string")
    if cycle is not None and target_time is not None:
        cycle = as_col(cycle)
        extra = (
            F.when((cycle == "HH") & values["hh"].isNull() & (F.length(target_time) >= 10), F.substring(target_time, 9, 2))
            .when((cycle == "MI") & values["hm"].isNull() & (F.length(target_time) >= 12), F.substring(target_time, 9, 4))
        )
    after_day = F.when(values["dt"].isNotNull(), extra)
    at_end = F.when(values["dt"].isNull(), extra)
    by_partitions = F.concat_ws("_", values["tb"], values["dt"], after_day, values["hh"], values["hm"], at_end)
    return F.when(base.rlike(r"^\.*[^.].*\."), F.regexp_extract(base, r"^(\.*[^.].*)\.[^.]*$", 1)).otherwise(by_partitions)


def codec_extension(codec: Column | str) -> Column:
    pairs = [F.lit(item) for pair in CODEC_EXTENSIONS.items() for item in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(as_col(codec))), F.lit(""))


def merged_name(stem: Column, codec: Column | str, fmt: Column | str) -> Column:
    """``stem.codec.format``; an unknown or unset codec adds nothing."""
    return F.concat(stem, F.coalesce(codec_extension(codec), F.lit("")), F.lit("."), as_col(fmt))


def clean_file_name(path: Column) -> Column:
    """File name without any suffix and without date runs: ``abc_20250120.tar.gz`` gives ``abc``."""
    bare = F.regexp_replace(base_name(path), r"^(\.*[^.]+)\..*$", "$1")
    return F.regexp_replace(bare, _DATE_RUN, "")


def name_without_date(name: Column) -> Column:
    return F.regexp_replace(name, _DATE_AFTER_MARK, "")


def align_name_with_partition(name: Column, dt: Column, hh: Column, hm: Column) -> Column:
    """The date run in a name cut to the granularity of its partition; 14, 12, 10, then 8 digits are looked for."""
    runs = [F.nullif(F.regexp_extract(name, r"\d{%d}" % n, 0), F.lit("")) for n in (14, 12, 10, 8)]
    run = F.coalesce(*runs)
    stamp = F.when(hm.isNotNull(), F.concat(dt, hm)).when(hh.isNotNull(), F.concat(dt, hh)).otherwise(dt)
    return F.when(run.isNotNull() & dt.isNotNull(), F.replace(name, run, stamp)).otherwise(name)


def prefix_from_directory(name: Column, directory: Column, pattern: str) -> Column:
    """Group 1 of ``pattern`` in the directory put before the name; no match leaves the name."""
    return F.when(
        directory.rlike(pattern), F.concat(F.regexp_extract(directory, pattern, 1), F.lit("_"), name)
    ).otherwise(name)


def wildcard_prefix(pattern_path: Column, path: Column) -> Column:
    """Path segments that stand where the pattern has a ``*``, joined by ``_``."""
    no_blank = lambda text: F.filter(F.split(text, "/"), lambda s: s != "")
    wanted, actual = no_blank(pattern_path), no_blank(path)
    hit = F.filter(F.arrays_zip(wanted.alias("p"), actual.alias("a")), lambda s: s["p"].contains("*"))
    joined = F.array_join(F.transform(hit, lambda s: s["a"]), "_")
    last = base_name(F.regexp_replace(path, "/+$", ""))
    return F.when((F.size(wanted) == F.size(actual)) & (joined != ""), joined).otherwise(last)


def partition_from_name(name: Column, pattern: str) -> Column:
    """Captured text of a regular expression in a file name; no match fails the job."""
    value = F.regexp_extract(name, pattern, 1)
    return F.when(name.rlike(pattern) & (value != ""), value).otherwise(
        F.raise_error(F.concat(F.lit("no partition value in name: "), name)).cast("string")
    )


def source_date(name: Column, partitions: Column) -> Column:
    """Date in a file name, else the partition's ``dt`` (or ``ym``) plus ``hh``."""
    in_name = F.nullif(F.regexp_extract(name, _SOURCE_DATE, 0), F.lit(""))
    day = F.coalesce(partitions["dt"], partitions["ym"], F.lit(""))
    return F.coalesce(in_name, F.concat(day, F.coalesce(partitions["hh"], F.lit(""))))


def target_path(template: Column | str, partitions: Column) -> Column:
    """``key=${...}`` segments of a delivery path filled from the partitions of the source.

    ``event_time`` stands for dt and hh together; prefixes etl_, cnsl_ and occr_
    are ignored and ``hr`` means ``hh``. A missing value fails the job.
    """
    text = F.replace(as_col(template), F.lit("hdfs://"), F.lit(""))
    names = ("dt", "hh", "hm", "ym", "nw", "sys")
    lookup = F.map_from_arrays(
        F.array(*[F.lit(n) for n in (*names, "event_time")]),
        F.array(*[partitions[n] for n in names], F.concat(partitions["dt"], partitions["hh"])),
    )

    def value_of(key: Column, values: Column) -> Column:
        plain = key
        for prefix in ("etl_", "cnsl_", "occr_"):
            plain = F.replace(plain, F.lit(prefix), F.lit(""))
        plain = F.replace(plain, F.lit("hr"), F.lit("hh"))
        missing = F.raise_error(F.concat(F.lit("no partition value for "), key)).cast("string")
        return F.coalesce(F.try_element_at(values, F.when(key == "event_time", key).otherwise(plain)), missing)

    def filled(segment: Column, values: Column) -> Column:
        key = F.regexp_extract(segment, r"^(.*)=\$\{.*?\}", 1)
        return F.when(
            segment.contains("=${"), bind(key, lambda k: F.concat(k, F.lit("="), value_of(k, values)))
        ).otherwise(segment)

    joined = bind(
        lookup, lambda values: F.array_join(F.transform(F.split(text, "/"), lambda part: filled(part, values)), "/")
    )
    return F.concat(F.when(text.contains("s3a://"), "").otherwise("hdfs://"), joined)


def schedule_of(path: Column, given: Column | None = None) -> Column:
    """Cron schedule: the given one, else by the period mark in the path."""
    marked = F.lit("")
    for mark, cron in reversed(PERIOD_SCHEDULES.items()):
        marked = F.when(path.contains(mark), cron).otherwise(marked)
    return marked if given is None else F.coalesce(F.nullif(given, F.lit("")), marked)


def landed_path(db: Column, tb: Column, *partitions: tuple[str, Column]) -> Column:
    """``/db=/tb=/k=v...`` of a landed partition."""
    parts = [F.concat(F.lit("/db="), db), F.concat(F.lit("/tb="), tb)]
    parts += [F.concat(F.lit(f"/{key}="), value) for key, value in partitions]
    return F.concat(*parts)


def partition_specs(parts: Column, defaults: Column, date_keys: Sequence[str] = ("dt", "hh", "hm")) -> Column:
    """Custom partitions; the default date ones come first when no date key is given."""
    dated = F.exists(parts, lambda part: F.array_contains(F.array(*[F.lit(k) for k in date_keys]), F.map_keys(part)[0]))
    return F.when(dated, parts).otherwise(F.concat(defaults, parts))


def notification_partitions(parts: Column, start: Column, resolve) -> Column:
    """Partitions sent with a notification: an ``empty`` entry clears the list, patterns are resolved."""
    cleared = F.exists(
        parts, lambda part: F.coalesce(F.try_element_at(part, F.lit("empty")), F.lit("")) != ""
    )
    filled = F.transform(
        parts,
        lambda part: F.transform_values(
            part, lambda _, value: F.when(value.rlike(r"\$\{.*?\}"), resolve(value, start)).otherwise(value)
        ),
    )
    return F.when(cleared, F.array().cast("array<map<string,string>>")).otherwise(filled)
