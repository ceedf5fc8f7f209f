"""Secret scans: three fixed patterns, and sliding-window entropy of candidate strings by character class."""

from __future__ import annotations

import functools
import math
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.llm.marks import SPANS, Shield, matches, searchable

#: The base patterns. Each is greedy, so a least length in it changes no match that is long enough.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "entropy")

#: Strings worth measuring: long runs of one token's characters with a digit and a letter.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
WINDOW = 20
#: Least entropy, in bits a character, of a window of each class; the first class whose pattern fits counts.
CLASSES = (
    ("hexadecimal", r"^(?:[0-9a-f]+|[0-9A-F]+)$", 2.95),
    ("one case", r"^(?:[0-9a-z]+|[0-9A-Z]+)$", 3.45),
    ("mixed", r"^[A-Za-z0-9+/_-]+$", 3.75),
)
#: Candidates that look random or long for a known reason: identifiers, dates, paths and slugs of words, filler. A group that
#: repeats is possessive: Java matches it in a loop then, and else by a call for each round, which ends the JVM on a long text.
ALLOWED = (
    r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    r"^\d{4}[-/_]\d{2}[-/_]\d{2}",
    r"^(?:[A-Za-z]*+\d{0,4}+[-_/+])++[A-Za-z]*+\d{0,4}+$",
    r"(?i)example|sample|dummy|placeholder|xxxx|0123456789|abcdefgh",
    r"(.)\1{5,}",
)
#: What is excused as a whole: candidates, and parts of cut ones, which may have separators left on either side.
WHOLE = (ALLOWED[0], ALLOWED[2])
WHOLE_PART = (rf"^[-_/+]*{ALLOWED[0][1:-1]}[-_/+]*$", ALLOWED[2])
#: What of a candidate is excused for a reason of its own, and no more: a leading date with its time, a word with what is joined
#: to it without a separator (a window on each side at most), a run of one character.
LOCAL = (
    rf"{ALLOWED[1]}(?:T\d{{2,6}}Z?)?",
    rf"[A-Za-z0-9]{{0,{WINDOW}}}(?i:{ALLOWED[3][4:]})[A-Za-z0-9]{{0,{WINDOW}}}",
    r"([A-Za-z0-9+/_-])\1{5,}",
)
_SPAN = "struct<start:int,rank:int,end:int>"


def _counted(count: Column) -> Column:
    """c log2 c, from a table."""
    return F.element_at(F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(WINDOW + 2)]), count + 1)


def _changed(counts: Column, at: Column, by: int) -> Column:
    return F.concat(
        F.slice(counts, F.lit(1), at - 1), F.array(F.element_at(counts, at) + by), F.slice(counts, at + 1, F.lit(len(ALPHABET)))
    )


def entropy_span(value: Column, least: Column) -> Column:
    """``struct(first, last)``: from the first to the last window of ``value`` with at least the entropy; null if none has.

    The window slides by one character. The counts of its characters and the sum of c log2 c follow by what enters and what
    leaves: H = log2(n) - sum / n.
    """
    codes = F.transform(F.split(value, "", -1), lambda c: F.when(F.length(c) > 0, F.instr(F.lit(ALPHABET), c)).otherwise(F.lit(0)))
    codes = F.filter(codes, lambda c: c > 0)
    start = F.struct(
        F.lit(0).alias("n"),
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("counts"),
        F.array().cast("array<int>").alias("window"),
        F.lit(0.0).alias("sum"),
        F.lit(None).cast("int").alias("first"),
        F.lit(None).cast("int").alias("last"),
    )

    def leave(state: Column) -> Column:
        code = F.element_at(state["window"], 1)
        count = F.element_at(state["counts"], code)
        fewer = F.struct(
            state["n"].alias("n"),
            _changed(state["counts"], code, -1).alias("counts"),
            F.slice(state["window"], 2, WINDOW).alias("window"),
            (state["sum"] + _counted(count - 1) - _counted(count)).alias("sum"),
            state["first"].alias("first"),
            state["last"].alias("last"),
        )
        return F.when(F.size(state["window"]) == WINDOW, fewer).otherwise(state)

    def enter(state: Column, code: Column) -> Column:
        count = F.element_at(state["counts"], code)
        return F.struct(
            (state["n"] + 1).alias("n"),
            _changed(state["counts"], code, 1).alias("counts"),
            F.concat(state["window"], F.array(code)).alias("window"),
            (state["sum"] + _counted(count + 1) - _counted(count)).alias("sum"),
            state["first"].alias("first"),
            state["last"].alias("last"),
        )

    def judge(state: Column, bound: Column) -> Column:
        hot = (state["n"] >= WINDOW) & (F.lit(math.log2(WINDOW)) - state["sum"] / WINDOW >= bound)
        return F.struct(
            state["n"].alias("n"),
            state["counts"].alias("counts"),
            state["window"].alias("window"),
            state["sum"].alias("sum"),
            F.coalesce(state["first"], F.when(hot, state["n"] - WINDOW)).alias("first"),
            F.when(hot, state["n"]).otherwise(state["last"]).alias("last"),
        )

    def once(value: Column, use) -> Column:
        """Name a value, so that it is worked out once."""
        return F.element_at(F.transform(F.array(value), use), 1)

    def slide(state: Column, code: Column, bound: Column) -> Column:
        return once(once(leave(state), lambda s: enter(s, code)), lambda s: judge(s, bound))

    def slid(bound: Column) -> Column:
        done = lambda s: F.when(s["first"].isNotNull(), F.struct(s["first"], s["last"]))
        return F.aggregate(codes, start, lambda state, code: slide(state, code, bound), done)

    # The bound is named too, or the patterns of the classes would run over the whole value for each of its characters.
    return once(least, slid)


def _least(value: Column) -> Column:
    bound = F.lit(None).cast("double")
    for _, pattern, least in reversed(CLASSES):
        bound = F.when(F.rlike(value, F.lit(pattern)), least).otherwise(bound)
    return bound


def _ranked(found: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end")))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["end"])), ",")


def _between(m: Column, cuts: Column) -> Column:
    """The parts of a candidate between ``cuts``, sorted ``struct(start, end)`` in the text that may overlap and reach beyond it."""
    start = F.struct(m["start"].alias("at"), F.array().cast(SPANS).alias("out"))

    def part(at: Column, end: Column) -> Column:
        value = F.substr(m["value"], at - m["start"] + 1, end - at)
        return F.when(end - at >= WINDOW, F.array(F.struct(at.alias("start"), end.alias("end"), value.alias("value")))).otherwise(F.array().cast(SPANS))

    def cut(state: Column, span: Column) -> Column:
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), F.concat(state["out"], part(state["at"], span["start"])).alias("out"))

    return F.aggregate(cuts, start, cut, lambda s: F.concat(s["out"], part(s["at"], m["end"])))


def with_secret_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``secret_base`` and ``secret_all``: sorted arrays of ``struct(start, rank, end)`` in code points.

    Base spans are the matches of the three patterns. Entropy spans are the hot parts of candidates. A candidate that a base span
    touches, or of which the allow-list excuses a part, is cut there, and what is left is judged as candidates of its own; only
    identifiers and slugs of words are excused as a whole. Only built-in functions are used, and nothing is shuffled.
    """
    plain = docs.withColumn("secret_text", searchable(F.col(text)))
    value = lambda m: F.regexp_extract(m["value"], ASSIGN, 1)
    assign = F.filter(matches(F.col("secret_text"), ASSIGN), lambda m: F.length(value(m)) >= ASSIGN_LEAST)
    base = F.array_sort(
        F.concat(
            _ranked(assign, "assign"), _ranked(matches(F.col("secret_text"), ACCESS), "access"), _ranked(matches(F.col("secret_text"), HEX), "hex")
        )
    )
    def promising(m: Column) -> Column:
        return F.rlike(m["value"], F.lit("[0-9]")) & F.rlike(m["value"], F.lit("[A-Za-z]"))

    def fits(m: Column, patterns: tuple[str, ...]) -> Column:
        return functools.reduce(operator.or_, [F.rlike(m["value"], F.lit(pattern)) for pattern in patterns])

    rough = F.filter(matches(F.col("secret_text"), CANDIDATE), lambda m: promising(m) & ~fits(m, WHOLE))
    found = plain.withColumn("secret_base", base).withColumn("secret_rough", rough)

    def cut(m: Column) -> Column:
        """The candidate, or what its base spans and excused parts leave of it."""
        touching = F.filter("secret_base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
        cuts = [F.transform(touching, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end")))]
        for pattern in LOCAL:
            local = matches(m["value"], pattern)
            cuts.append(F.transform(local, lambda c: F.struct((m["start"] + c["start"]).alias("start"), (m["start"] + c["end"]).alias("end"))))
        parts = F.filter(_between(m, F.array_sort(F.concat(*cuts))), lambda part: promising(part) & ~fits(part, WHOLE_PART))
        return F.when((F.size(touching) == 0) & ~fits(m, LOCAL), F.array(m)).otherwise(parts)

    found = found.withColumn("secret_rough", F.flatten(F.transform("secret_rough", cut)))
    hot = F.transform(
        "secret_rough",
        lambda m: F.struct(m["start"].alias("at"), entropy_span(m["value"], _least(m["value"])).alias("hot")),
    )
    hot = F.transform(
        F.filter(hot, lambda h: h["hot"].isNotNull()),
        lambda h: F.struct(
            (h["at"] + h["hot"]["first"]).cast("int").alias("start"),
            F.lit(KINDS.index("entropy")).alias("rank"),
            (h["at"] + h["hot"]["last"]).cast("int").alias("end"),
        ),
    )
    none = F.array().cast(f"array<{_SPAN}>")
    return (
        found.withColumn("secret_hot", F.when(F.size("secret_rough") > 0, hot).otherwise(none))
        .withColumn("secret_all", F.array_sort(F.concat("secret_base", "secret_hot")))
        .drop("secret_text", "secret_rough", "secret_hot")
    )


def scan_secrets(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, n_assign, n_access, n_hex, n_entropy, base_sha256, spans`` of every document.

    Spans are ``kind:start:end`` by start and then kind, joined by commas; without spans they are an empty string. Null texts
    count as empty, null keys stay, repeated rows are scanned each, an empty table gives no rows, other columns are ignored.
    """
    found = with_secret_spans(docs.select(F.col(key), F.col(text).alias("text")), "text")

    def number(kind: str) -> Column:
        return F.size(F.filter("secret_all", lambda s: s["rank"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        key, *map(number, KINDS), F.sha2(_joined(F.col("secret_base")), 256).alias("base_sha256"), _joined(F.col("secret_all")).alias("spans")
    )


def redact_secrets(docs: DataFrame, text: str = "text", length: str | None = "n_chars", word: str = "[secret]") -> DataFrame:
    """``docs`` with every span replaced by ``word``; overlapping spans count as one. ``length`` is set anew where it changed.

    Texts without a secret, and null texts, stay as they are; columns keep their names, order and values, whatever they are called.
    """
    held = Shield(docs)
    text_, length_ = held.inner_name(text), held.inner_name(length)
    found = with_secret_spans(held.inner, text_)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def replace(state: Column, span: Column) -> Column:
        between = F.substring(F.col(text_), state["at"] + 1, span["start"] - state["at"])
        fresh = F.struct(span["end"].alias("at"), F.concat(state["out"], F.array(between, F.lit(word))).alias("out"))
        longer = F.struct(F.greatest(state["at"], span["end"]).alias("at"), state["out"].alias("out"))
        return F.when((span["start"] >= state["at"]) | (F.size(state["out"]) == 0), fresh).otherwise(longer)

    def ended(state: Column) -> Column:
        return F.concat(F.array_join(state["out"], ""), F.substring(F.col(text_), state["at"] + 1, F.length(text_)))

    clean = F.when(F.size("secret_all") > 0, F.aggregate("secret_all", start, replace, ended)).otherwise(F.col(text_))
    out = found.withColumn("secret_clean", clean)
    changes = {text: F.col("secret_clean")}
    if length_ is not None:
        changes[length] = F.when(F.size("secret_all") > 0, F.length("secret_clean").cast("long")).otherwise(F.col(length_))
    return held.restored(out, changes)
