"""Personal data replaced by keyed surrogates of the same type, format, gender and script."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.timepat import bind
from quayside.llm.marks import Shield, matches, searchable
from quayside.session import local_table, settle

#: What is looked for, in this order of preference where two would start at one place.
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_HONORIFICS = {
    "m": ("Mr", "Herr", "Monsieur", "Señor", "Sr", "Господин"),
    "f": ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "Sra", "Госпожа"),
}
_TITLE = "|".join(sorted((t for titles in _HONORIFICS.values() for t in titles), key=len, reverse=True))
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": rf"(?<![\w.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\w|\.\d)",
    "phone": r"(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)[ .-]?)?\d{2,4}(?:[ .-]?\d{2,4}){1,4}(?!\w)|(?<![\w(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?!\w)",
    "ssn": r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])",
    "card": r"(?<!\w)\d(?:[ -]?\d){12,18}(?!\w)",
    "name": rf"(?<!\p{{L}})(?:{_TITLE})\.? \p{{Lu}}\p{{L}}+(?: \p{{Lu}}\p{{L}}+)?",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Every match holds a digit, an at sign or a title.
HINT = rf"[0-9@]|(?:{_TITLE})\.? "

#: First names by script and gender, and syllables of family names by script.
FIRST = {
    ("latin", "m"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Karl Leon Martin Nils Oscar Paul",
    ("latin", "f"): "Anna Berta Clara Diana Emma Flora Greta Helen Irene Julia Karin Laura Maria Nora Olga Paula",
    ("cyrillic", "m"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл Лев Максим Никита Олег Павел Роман Семён Тимур",
    ("cyrillic", "f"): "Алла Вера Галина Дарья Елена Жанна Зоя Инна Ксения Лидия Мария Нина Ольга Полина Раиса Софья",
}
SYLLABLES = {
    "latin": "bar cor del fan gor hal kin lor men nor par ros sel tor van wil",
    "cyrillic": "бар вал гор дан зор кам лин мар нор пет рос сав тим фед хар чер",
}
#: From this attempt on a surrogate is longer than its form asks for, by one more character each time.
LONGER_FROM = 8
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def kind_of(value: Column) -> Column:
    """The first kind whose pattern is the whole value; surroundings do not matter any more."""
    found = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        found = F.when(F.rlike(value, F.lit(rf"^(?:{pattern})$")), kind).otherwise(found)
    return found


def _person(value: Column) -> Column:
    return F.regexp_replace(value, rf"^(?:{_TITLE})\.? ", "")


def gender(value: Column) -> Column:
    female = "|".join(sorted(_HONORIFICS["f"], key=len, reverse=True))
    return F.when(F.rlike(value, F.lit(rf"^(?:{female})\.? ")), "f").otherwise("m")


def script(value: Column) -> Column:
    return F.when(F.rlike(_person(value), F.lit(r"\p{IsCyrillic}")), "cyrillic").otherwise("latin")


def identity(kind: Column, value: Column) -> Column:
    """What makes two mentions one entity: digits of numbers, lower-cased addresses, names with gender but without title."""
    number = F.regexp_replace(value, r"[^0-9]", "")
    name = F.concat_ws("|", gender(value), script(value), _person(value))
    return (
        F.when(kind.isin("phone", "card", "ssn"), number).when(kind == "name", name).otherwise(F.lower(value))
    )


def _digest(secret: Column, *parts: Column) -> Column:
    """256 hex digits keyed by the secret: nested hashes, so that the key cannot be extended."""
    message = F.concat_ws("\u0001", *[p.cast("string") for p in parts])
    blocks = [F.sha2(F.concat(secret, F.sha2(F.concat(secret, F.lit(f"{i}:"), message), 256)), 256) for i in range(4)]
    return F.concat(*blocks)


def _draw(digest: Column, place: Column, size: int) -> Column:
    """A number below ``size`` from the two hex digits at ``place``, round the digest."""
    at = F.pmod(2 * place, F.lit(254)) + 1
    return F.pmod(F.conv(F.substr(digest, at, F.lit(3)), 16, 10).cast("int"), F.lit(size))


def _letter(alphabet: str, number: Column) -> Column:
    return F.substr(F.lit(alphabet), number + 1, F.lit(1))


def _reshaped(value: Column, digest: Column) -> Column:
    """Every letter and digit replaced by another of its kind; all else stays."""
    chars = F.split(value, "")

    def fresh(char: Column, i: Column, drawn: Column) -> Column:
        return (
            F.when(F.rlike(char, F.lit("^[0-9]$")), _draw(drawn, i, 10).cast("string"))
            .when(F.rlike(char, F.lit("^[a-z]$")), _letter(_LETTERS, _draw(drawn, i, 26)))
            .when(F.rlike(char, F.lit("^[A-Z]$")), _letter(_LETTERS.upper(), _draw(drawn, i, 26)))
            .otherwise(char)
        )

    # Bound, so that the whole value is hashed once and not for each of its characters.
    return bind(digest, lambda drawn: F.array_join(F.transform(chars, lambda char, i: fresh(char, i, drawn)), ""))


def _odd_sum(digits: Column) -> Column:
    """Luhn sum of a digit string."""
    chars = F.transform(F.reverse(F.filter(F.split(digits, ""), lambda c: c != "")), lambda c: c.cast("int"))
    doubled = F.transform(chars, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d)


def _card(number: Column, digest: Column) -> Column:
    """As many digits; valid by its check digit if the original is."""
    fresh = _reshaped(number, digest)
    body = F.substr(fresh, F.lit(1), F.length(fresh) - 1)
    check = F.pmod(10 - _odd_sum(F.concat(body, F.lit("0"))) % 10, F.lit(10)).cast("string")
    return F.when(_odd_sum(number) % 10 == 0, F.concat(body, check)).otherwise(fresh)


def _name(ident: Column, digest: Column, attempt: Column) -> Column:
    """A first name of the gender in the script, and a family name if there was one; later attempts have longer family names."""
    parts = F.split(ident, r"\|")
    out = F.lit(None).cast("string")
    for (script_, gender_), names in FIRST.items():
        syllables = F.array(*map(F.lit, SYLLABLES[script_].split()))
        chosen = F.transform(F.sequence(F.lit(1), F.lit(3) + attempt), lambda i: F.element_at(syllables, _draw(digest, i, 16) + 1))
        family = F.initcap(F.array_join(chosen, ""))
        first = F.element_at(F.array(*map(F.lit, names.split())), _draw(digest, F.lit(0), 16) + 1)
        whole = F.when(F.contains(parts[2], F.lit(" ")), F.concat_ws(" ", first, family)).otherwise(family)
        out = F.when((parts[0] == gender_) & (parts[1] == script_), whole).otherwise(out)
    return out


def _more(kind: Column, ident: Column, attempt: Column, secret: Column, put) -> Column:
    """What ``put`` makes of the extra places of a late attempt, joined; empty before."""
    digest = _digest(secret, F.lit("longer"), kind, ident, attempt)
    extra = F.array_join(F.transform(F.sequence(F.lit(1), attempt - (LONGER_FROM - 1)), lambda i: put(digest, i)), "")
    return F.when(attempt >= LONGER_FROM, extra).otherwise(F.lit(""))


def surrogate(kind: Column, ident: Column, attempt: Column, secret: Column) -> Column:
    """The replacement of an entity, in the form of its identity; late attempts are longer, so that there is always room."""
    letters = _more(kind, ident, attempt, secret, lambda digest, i: _letter(_LETTERS, _draw(digest, i, 26)))
    digits = _more(kind, ident, attempt, secret, lambda digest, i: _draw(digest, i, 10).cast("string"))
    octets_more = _more(kind, ident, attempt, secret, lambda digest, i: F.concat(F.lit("."), (_draw(digest, i, 254) + 1).cast("string")))
    digest = _digest(secret, kind, ident, attempt)
    at = F.instr(ident, "@")
    domain = F.substr(ident, at + 1)
    top = F.regexp_extract(domain, r"\.[^.]*$", 0)
    host = F.substr(domain, F.lit(1), F.length(domain) - F.length(top))
    email = F.concat(
        _reshaped(F.substr(ident, F.lit(1), at - 1), digest), letters, F.lit("@"), _reshaped(host, _digest(secret, F.lit("domain"), domain, F.lit(0))), top
    )
    octets = F.transform(F.split(ident, r"\."), lambda o, i: (_draw(digest, i, 254) + 1).cast("string"))
    return (
        F.when(kind == "email", email)
        .when(kind == "ip", F.concat(F.array_join(octets, "."), octets_more))
        .when(kind == "card", F.concat(_card(ident, digest), digits))
        .when(kind == "name", _name(ident, digest, attempt))
        .otherwise(F.concat(_reshaped(ident, digest), digits))
    )


def _formatted(kind: Column, value: Column, fresh: Column) -> Column:
    """The replacement in the format of this mention: separators and titles of the mention, digits and names of the surrogate.

    Digits of a longer surrogate follow the last one of the mention.
    """
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))

    def put(state: Column, char: Column) -> Column:
        digit = F.rlike(char, F.lit("^[0-9]$"))
        return F.struct(
            (state["at"] + digit.cast("int")).alias("at"),
            F.concat(state["out"], F.when(digit, F.substr(fresh, state["at"], F.lit(1))).otherwise(char)).alias("out"),
        )

    number = F.aggregate(F.split(value, ""), start, put, lambda s: F.concat(s["out"], F.substr(fresh, s["at"], F.length(fresh))))
    title = F.regexp_extract(value, rf"^(?:{_TITLE})\.? ", 0)
    return F.when(kind.isin("phone", "card", "ssn"), number).when(kind == "name", F.concat(title, fresh)).otherwise(fresh)


def with_entities(docs: DataFrame, text: str, name: str = "pii_found") -> DataFrame:
    """``docs`` with an array of ``struct(start, end, value, kind, ident)`` of the personal data in each whole text."""
    found = docs.withColumn("pii_match", matches(searchable(F.col(text)), ANY, HINT))

    def described(m: Column) -> Column:
        kind = kind_of(m["value"])
        return F.struct(m["start"], m["end"], m["value"], kind.alias("kind"), identity(kind, m["value"]).alias("ident"))

    return found.withColumn(name, F.transform("pii_match", described)).drop("pii_match")


def _with_secret(rows: DataFrame, secret_key: str) -> DataFrame:
    """``rows`` with the key as column ``pii_secret``, from a one-row table that no plan text shows."""
    return rows.withColumn("pii_secret", local_table(rows.sparkSession, {"secret": [secret_key]}).scalar())


def retries(entities: DataFrame, secret_key: str) -> DataFrame:
    """``(kind, ident, attempt)`` of the entities whose first surrogates would collide; all others have attempt 0.

    ``entities(kind, ident)`` are distinct, of the whole corpus. A surrogate is refused if it is itself an entity there, or if
    an entity of a smaller identity has it; the refused ones draw again until none is left. There is no last round: surrogates of
    late attempts are longer, so that even an entity without a letter or digit to change finds a free one. Every round stores only the
    entities that have drawn again, and joins with them.
    """
    moved = entities.limit(0).withColumn("attempt", F.lit(0))
    while True:
        now = entities.join(moved, ["kind", "ident"], "left").withColumn("attempt", F.coalesce("attempt", F.lit(0)))
        fresh = surrogate(F.col("kind"), F.col("ident"), F.col("attempt"), F.col("pii_secret"))
        drawn = settle(_with_secret(now, secret_key).withColumn("fresh", fresh).drop("pii_secret"), "drawn")
        meaning = F.when(F.col("kind") == "name", F.regexp_extract("ident", r"^([mf]\|[a-z]+\|)", 1)).otherwise(F.lit(""))
        taken = drawn.withColumn("as_ident", F.concat(meaning, "fresh"))
        firsts = taken.groupBy("kind", "as_ident").agg(F.min("ident").alias("owner"), F.count(F.lit(1)).alias("claims")).where("claims > 1")
        clash = taken.join(firsts, ["kind", "as_ident"]).where("ident <> owner").select("kind", "ident", "attempt")
        real = taken.join(entities.select("kind", F.col("ident").alias("as_ident")), ["kind", "as_ident"], "left_semi").select("kind", "ident", "attempt")
        again = settle(clash.unionByName(real).distinct().withColumn("attempt", F.col("attempt") + 1), "again")
        if again.isEmpty():
            return moved
        moved = settle(moved.join(again, ["kind", "ident"], "left_anti").unionByName(again), "moved")


def replace_personal_data(docs: DataFrame, secret_key: str, text: str = "text", key: str = "doc_id", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with every detected entity replaced, ``pii_count`` and ``pii_spans`` (kind:start:end in the old text).

    An entity has one surrogate in the whole corpus, and two entities never share one. The surrogate follows from the secret,
    which stands in no plan. Texts without personal data, and null texts, stay as they are. Rows with null or repeated keys are
    treated each; an empty table stays empty; ``length`` is set anew where the text changed. Only entities and the few that
    draw again are shuffled; texts are joined with those by key. Other columns keep their names and values whatever they are called;
    only columns already called ``pii_count`` and ``pii_spans`` are replaced, and no column ever holds the key.
    """
    held = Shield(docs)
    text_, key_, length_ = held.inner_name(text), held.inner_name(key), held.inner_name(length)
    found = with_entities(_with_secret(held.inner, secret_key), text_)
    mentions = settle(
        found.where(F.size("pii_found") > 0).select(F.col(key_).alias("k"), F.explode("pii_found").alias("e")).select("k", "e.kind", "e.ident"),
        "mentions",
    )
    moved = settle(retries(settle(mentions.select("kind", "ident").distinct(), "entities"), secret_key), "retries")
    turns = (
        mentions.join(moved, ["kind", "ident"])
        .distinct()
        .groupBy("k")
        .agg(F.map_from_entries(F.collect_list(F.struct(F.concat_ws("|", "kind", "ident"), "attempt"))).alias("pii_turns"))
    )
    turns = settle(turns, "turns")
    joined = found.join(turns, found[key_].eqNullSafe(turns["k"]), "left").drop("k")

    def put(state: Column, e: Column) -> Column:
        turn = F.coalesce(F.element_at("pii_turns", F.concat_ws("|", e["kind"], e["ident"])), F.lit(0))
        fresh = _formatted(e["kind"], e["value"], surrogate(e["kind"], e["ident"], turn, F.col("pii_secret")))
        between = F.substring(F.col(text_), state["at"] + 1, e["start"] - state["at"])
        return F.struct(e["end"].alias("at"), F.concat(state["out"], F.array(between, fresh)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    changed = F.aggregate(
        "pii_found", start, put, lambda s: F.concat(F.array_join(s["out"], ""), F.substring(F.col(text_), s["at"] + 1, F.length(text_)))
    )
    named = F.transform("pii_found", lambda e: F.concat_ws(":", e["kind"], e["start"], e["end"]))
    out = joined.withColumn("pii_text", F.when(F.size("pii_found") > 0, changed).otherwise(F.col(text_)))
    changes = {text: F.col("pii_text")}
    if length_ is not None:
        changes[length] = F.when(F.size("pii_found") > 0, F.length("pii_text").cast("long")).otherwise(F.col(length_))
    return held.restored(out, changes, {"pii_count": F.size("pii_found").cast("long"), "pii_spans": F.array_join(named, ",")})
