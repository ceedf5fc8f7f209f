"""One query for each operator, with production parameters over whole tables, and SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import bit_sliced, embedding_dups, fingerprints, merkle, mixing, packing, repair, secrets, surrogates, token_counts, token_files, toxicity, url_filter
from quayside.session import configure, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"
TOKEN_LIMIT = 512
WINDOW = 1024

#: Host, path and verdict of the URL rules.
URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)

#: Shares of the mixture; sources count alike. A domain is what a source's number says: even ones web, odd ones forum.
DOMAIN_WEIGHTS = {"web": 3, "forum": 2}
LANGUAGE_WEIGHTS = {"en": 8, "de": 5, "fr": 5, "es": 4}
MIX_SHARE, MIX_EPOCHS, MIX_SEED = 0.6, 2, 7

MERKLE_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

#: A key for checks only; jobs bring their own.
CHECK_SECRET = "surrogate-check-key"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


MIX_LEVELS = (
    mixing.Level("domain", "CASE WHEN source RLIKE '[02468]$' THEN 'web' WHEN source RLIKE '[13579]$' THEN 'forum' END", DOMAIN_WEIGHTS),
    mixing.Level("language", "lang", LANGUAGE_WEIGHTS),
    mixing.Level("origin", "source"),
)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mixture takes: documents by leaf, epoch and place."""
    taken = mixing.mix(read(spark, sf_dir, "documents"), MIX_LEVELS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return taken.select(
        "doc_id",
        F.col("mix_domain").alias("domain"),
        F.col("mix_language").alias("language"),
        F.col("mix_origin").alias("origin"),
        F.col("mix_epoch").alias("epoch"),
        F.col("mix_key").alias("place"),
    )


def op2_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dups.near_duplicate_vectors(read(spark, sf_dir, "embeddings"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.with_token_counts(docs, public_tokenizers.path(TOKENIZER))
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    return counted.select("doc_id", size.alias("n_bytes"), "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(read(spark, sf_dir, "pages"), URL_RULES)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan_secrets(read(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), WINDOW)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.with_toxicity(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        toxicity.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(read(spark, sf_dir, "documents"))


def op9_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_personal_data(read(spark, sf_dir, "documents").select("doc_id", "text"), CHECK_SECRET)


def op10_simhash_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    grouped = bit_sliced.group_near_duplicates(read(spark, sf_dir, "documents"))
    return grouped.select("doc_id", "fingerprint", "component_id")


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with rows dropped, emptied, cut off, repeated or given another role, by the checksum of their place."""
    place = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    chosen = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(place) % 20).alias("damage")).where("damage <> 0")
    text = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("damage") == 4, "user").otherwise(F.col("role"))
    copies = F.array_repeat(F.lit(1), F.when(F.col("damage") == 3, 2).otherwise(1))
    return chosen.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    return repair_damaged(rows)


def repair_damaged(rows: DataFrame) -> DataFrame:
    """Every original conversation with its faults, edits and the digest of its repaired rows."""
    mended = repair.repair_conversations(damaged(rows))
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    found = mended.summary.select("conv", *numbers, "audit")
    hashed = repair.conversation_digests(mended.rows)
    # Aggregates, and not joins: a null key is a key, and conversations that lost all rows stay.
    nothing = rows.select(F.col("conv_id").alias("conv")).distinct()
    both = found.unionByName(hashed, allowMissingColumns=True).unionByName(nothing, allowMissingColumns=True)
    columns = [F.coalesce(F.max(n), F.lit(0)).cast("long").alias(n) for n in numbers]
    return (
        both.groupBy("conv")
        .agg(*columns, F.coalesce(F.max("audit"), F.lit("")).alias("audit"), F.coalesce(F.max("digest"), F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
        .withColumnRenamed("conv", "conv_id")
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = read(spark, sf_dir, "documents"), scratch_path(configure(spark), "token-ids")
    token_files.write_token_files(docs, public_tokenizers.path(TOKENIZER), path)
    return token_files.read_token_files(spark, path)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    now = [F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars")) if c == "n_chars" else F.col(c) for c in MERKLE_FIELDS]
    proved = merkle.manifest(docs, MERKLE_FIELDS, found=merkle.leaf(*now))
    return proved.select("doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root", "verified")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(configure(spark), sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_mixing,
        op2_embedding_dups,
        op3_token_counts,
        op4_url_filter,
        op5_secrets,
        op6_packing,
        op7_toxicity,
        op8_fingerprints,
        op9_surrogates,
        op10_simhash_dups,
        op11_repair,
        op12_token_files,
        op13_merkle,
        pipeline,
    )
}



def _values(rows: list[tuple]) -> str:
    """Rows as the list of a ``VALUES`` clause."""
    return ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in row) + ")" for row in rows)


_WORDS = url_filter.Vocabulary()
_TERMS = [(t, True, 0) for t in _WORDS.strict] + [(t, False, w) for t, w in _WORDS.soft.items() if t not in _WORDS.strict]

#: A term counts if neither side of one of its places has an ASCII letter or digit; the text is lower-cased before.
OP4_SQL = f"""
WITH u AS (
  SELECT row_number() OVER () AS row_id, page_id, coalesce(url, '') AS url,
         CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest,
         translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered
  FROM pages),
p AS (
  SELECT row_id, page_id, lowered, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host
  FROM u),
rules(verdict, host, path) AS (VALUES {_values([(r.verdict, r.host, r.path) for r in URL_RULES])}),
fit AS (
  SELECT row_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM p JOIN rules r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY row_id),
terms(term, strict, weight) AS (VALUES {_values(_TERMS)}),
hits AS (
  SELECT row_id, count(*) FILTER (strict) AS strict_hits, count(*) FILTER (NOT strict) AS soft_hits, CAST(sum(weight) AS BIGINT) AS soft_weight
  FROM p JOIN terms ON regexp_matches(lowered, '(^|[^a-z0-9])' || term || '($|[^a-z0-9])') GROUP BY row_id)
SELECT page_id, p.host, p.path, fit.rule,
       coalesce(fit.verdict, CASE WHEN strict_hits > 0 OR (soft_hits >= {url_filter.SOFT_TERMS_LEAST} AND soft_weight >= {_WORDS.limit}) THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(strict_hits, 0) AS strict_hits, coalesce(soft_hits, 0) AS soft_hits, coalesce(soft_weight, 0) AS soft_weight
FROM p LEFT JOIN fit USING (row_id) LEFT JOIN hits USING (row_id)
"""



def _shared(depth: int) -> str:
    """Quotas of the nodes of one level: short nodes get their supply, the others share what is left by weight."""
    level, names = MIX_LEVELS[depth], [each.name for each in MIX_LEVELS[: depth + 1]]
    here, above = ", ".join(names), names[:-1]
    weight = " ".join(f"WHEN '{k}' THEN {v}" for k, v in level.weights.items())
    weight = f"CASE {level.name} {weight} ELSE {level.default} END" if weight else str(level.default)
    if above:
        same = " AND ".join(f"q.{n} IS NOT DISTINCT FROM n.{n}" for n in above)
        budget = f"(SELECT quota FROM quota{depth - 1} q WHERE {same})"
    else:
        budget = f"(SELECT least(floor(sum(tokens) * {MIX_SHARE}::DOUBLE)::HUGEINT, sum(supply)) FROM leaves)"
    group = f"PARTITION BY {', '.join(above)} " if above else ""
    order = f"{group}ORDER BY ratio ASC NULLS LAST, {level.name} ASC NULLS FIRST"
    return f"""
nodes{depth} AS (SELECT {here}, sum(supply)::HUGEINT AS supply, ({weight})::HUGEINT AS weight FROM leaves GROUP BY {here}),
ratios{depth} AS (
  SELECT *, {budget} AS budget, CASE WHEN supply > 0 THEN supply::DOUBLE / weight::DOUBLE END AS ratio, CASE WHEN supply > 0 THEN weight ELSE 0 END AS w
  FROM nodes{depth} n),
sums{depth} AS (
  SELECT *, coalesce(sum(supply) OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS taken,
         sum(w) OVER ({order} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_weight
  FROM ratios{depth}),
short{depth} AS (
  SELECT *, bool_and(ratio IS NOT NULL AND supply * left_weight <= (budget - taken) * w)
              OVER ({order} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS short
  FROM sums{depth}),
rest{depth} AS (
  SELECT *, coalesce(sum(supply) FILTER (short) OVER ({group}), 0) AS used, coalesce(sum(w) FILTER (NOT short) OVER ({group}), 0) AS rest
  FROM short{depth}),
quota{depth} AS (
  SELECT {here}, CASE WHEN ratio IS NULL THEN 0 WHEN short THEN supply ELSE (budget - used) * w // rest END::HUGEINT AS quota FROM rest{depth}),"""


_NODES = ", ".join(level.name for level in MIX_LEVELS)


def _same_leaf(a: str, b: str) -> str:
    return " AND ".join(f"{a}.{level.name} IS NOT DISTINCT FROM {b}.{level.name}" for level in MIX_LEVELS)


def _place(epoch: str) -> str:
    return f"md5('{MIX_SEED}:' || {epoch} || ':' || coalesce(d.doc_id::VARCHAR, ''))"


#: The running sum over a leaf is written plainly here.
OP1_SQL = f"""
WITH docs AS (
  SELECT doc_id, CASE WHEN regexp_matches(source, '[02468]$') THEN 'web' WHEN regexp_matches(source, '[13579]$') THEN 'forum' END AS domain,
         lang AS language, source AS origin, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS tokens
  FROM documents),
leaves AS (SELECT {_NODES}, sum(tokens) AS tokens, sum(tokens) * {MIX_EPOCHS} AS supply FROM docs GROUP BY {_NODES}),
{"".join(map(_shared, range(len(MIX_LEVELS)))).lstrip()}
given AS (
  SELECT l.* EXCLUDE (supply), (quota // tokens)::BIGINT AS whole, quota % tokens AS rest
  FROM leaves l JOIN quota{len(MIX_LEVELS) - 1} q ON {_same_leaf("l", "q")} WHERE quota > 0),
placed AS (
  SELECT {", ".join(f"g.{level.name}" for level in MIX_LEVELS)}, g.rest, {_place("(whole + 1)")} AS place, sum(d.tokens) AS tokens
  FROM docs d JOIN given g ON {_same_leaf("d", "g")} WHERE g.rest > 0 GROUP BY ALL),
running AS (SELECT *, sum(tokens) OVER (PARTITION BY {_NODES} ORDER BY place ROWS UNBOUNDED PRECEDING) AS upto FROM placed),
cuts AS (SELECT {_NODES}, place AS cut FROM running WHERE upto >= rest AND upto - tokens < rest),
taken AS (
  SELECT d.doc_id, {", ".join(f"d.{level.name}" for level in MIX_LEVELS)},
         unnest(range(1, 1 + g.whole + CASE WHEN {_place("(g.whole + 1)")} <= c.cut THEN 1 ELSE 0 END)) AS epoch
  FROM docs d JOIN given g ON {_same_leaf("d", "g")} LEFT JOIN cuts c ON {_same_leaf("g", "c")})
SELECT d.*, {_place("epoch")} AS place FROM taken d
"""



def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    bit = "xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)"
    byte = f"list_reduce(list_concat([xor(c, b)], [0::BIGINT for i in range(8)]), lambda x, y: {bit})"
    codes = f"[ord(ch)::BIGINT for ch in string_split({text}, '')]"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda c, b: {byte}), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || ({value}::VARCHAR), '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_field(n_chars if c == "n_chars" else c) for c in MERKLE_FIELDS) + ")"


#: All levels node by node; trees[0] has the languages' trees, trees[1] the tree over their roots.
OP13_SQL = f"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS row_id, doc_id, lang, {_leaf("n_chars")} AS leaf,
         {_leaf("(CASE WHEN (" + _crc32("doc_id::VARCHAR") + ") % 7 = 0 THEN n_chars + 1 ELSE n_chars END)")} AS found
  FROM documents),
leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, found) - 1 AS pos FROM rows),
tree AS (
  SELECT lang, 0 AS depth, pos, leaf AS hash, count(*) OVER (PARTITION BY lang) AS n FROM leaves
  UNION ALL
  SELECT lang, depth + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2 FROM tree WHERE n > 1 GROUP BY lang, depth, pos // 2, n),
subroots AS (SELECT lang, hash AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1),
upper AS (
  SELECT 0 AS depth, pos, subroot AS hash, n FROM subroots
  UNION ALL
  SELECT depth + 1, pos // 2, sha256(string_agg(hash, '' ORDER BY pos)), (n + 1) // 2 FROM upper WHERE n > 1 GROUP BY depth, pos // 2, n),
steps AS (
  SELECT l.row_id, t.depth, t.hash AS sibling, t.pos < xor(t.pos, 1::BIGINT) AS is_before
  FROM leaves l JOIN tree t ON l.lang IS NOT DISTINCT FROM t.lang AND t.n > 1 AND t.pos = xor(l.pos >> t.depth, 1::BIGINT)
  UNION ALL
  SELECT l.row_id, 1000 + u.depth, u.hash, u.pos < xor(u.pos, 1::BIGINT)
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang JOIN upper u ON u.n > 1 AND u.pos = xor(s.pos >> u.depth, 1::BIGINT)),
proofs AS (SELECT row_id, string_agg(sibling, '' ORDER BY depth) AS siblings FROM steps GROUP BY row_id),
depths AS (SELECT DISTINCT lang, depth FROM tree WHERE n > 1),
ladder AS (
  SELECT l.row_id, d.depth, d.depth AS rung FROM leaves l JOIN depths d ON l.lang IS NOT DISTINCT FROM d.lang
  UNION ALL
  SELECT l.row_id, 1000 + d.depth, NULL FROM leaves l, (SELECT DISTINCT depth FROM upper WHERE n > 1) d),
rungs AS (
  SELECT row_id, row_number() OVER (PARTITION BY row_id ORDER BY depth) AS step, sibling, is_before
  FROM ladder LEFT JOIN steps USING (row_id, depth)),
folded AS (
  SELECT row_id, 0::BIGINT AS step, found AS hash FROM leaves
  UNION ALL
  SELECT f.row_id, r.step, sha256(CASE WHEN sibling IS NULL THEN hash WHEN is_before THEN sibling || hash ELSE hash || sibling END)
  FROM folded f JOIN rungs r ON r.row_id = f.row_id AND r.step = f.step + 1)
SELECT l.doc_id, l.leaf, s.subroot, top.hash AS root, sha256(coalesce(p.siblings, '')) AS proof_sha256,
       arg_max(f.hash, f.step) AS folded_root, arg_max(f.hash, f.step) = top.hash AS verified
FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang JOIN (SELECT hash FROM upper WHERE n = 1) top ON true
     LEFT JOIN proofs p USING (row_id) JOIN folded f USING (row_id)
GROUP BY l.row_id, l.doc_id, l.leaf, s.subroot, top.hash, p.siblings
"""



def _moves() -> str:
    """All ways from a state over one row, or to the end: edits, cost, state behind, lines put in front, role of the row (null: gone)."""
    after = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    roles = {"u": "user", "a": "assistant"}
    out = []
    for state in after:
        here, edits, lines = state, "", []
        for inserted in range(3):
            for letter in "suaSUA?!x":
                ways = [("D", 3, here, "gone")]
                cut = 1 if letter in "SUA!" else 0
                if letter != "x":
                    fresh = "a" if here == 2 else "u"
                    ways.append(("R", 2 + cut, after[here][fresh], roles[fresh]))
                    if letter.lower() in after[here]:
                        ways.append(("K", cut, after[here][letter.lower()], "own"))
                out += [(state, letter, edits + e, 2 * inserted + cost, to, lines_of(lines), kind) for e, cost, to, kind in ways]
            if here in (0, 3):
                out.append((state, "end", edits, 2 * inserted, 0, lines_of(lines), "gone"))
            fresh = "a" if here == 2 else "u"
            edits, lines, here = edits + "I", [*lines, roles[fresh] + ":"], after[here][fresh]
    return _values(out)


def lines_of(lines: list[str]) -> str:
    """Lines that each end with a line break, in SQL's text."""
    return "".join(f"{line}|" for line in lines)


#: From the end of each conversation: the least cost, and the ASCII-least edits with it, from each state on. ``|`` in the lines put in
#: front stands for the line break.
OP11_SQL = f"""
WITH RECURSIVE marked AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS damage
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN damage = 4 THEN 'user' ELSE role END AS role,
         CASE damage WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN damage = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM marked WHERE damage <> 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
         count(*) OVER (PARTITION BY conv_id) AS n,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS ended
  FROM damaged),
faulty AS (
  SELECT *, CASE WHEN ended = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                 WHEN right(ended, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair
  FROM numbered),
word AS (
  SELECT *, CASE WHEN fault IN ('blank', 'duplicate') THEN 'x'
                 WHEN left(role, 1) IN ('s', 'u', 'a') THEN CASE WHEN fault = 'truncated' THEN upper(left(role, 1)) ELSE left(role, 1) END
                 WHEN fault = 'truncated' THEN '!' ELSE '?' END AS letter
  FROM faulty),
moves(state, letter, edits, cost, next, lines, kind) AS (VALUES {_moves()}),
best AS (
  SELECT * FROM (
    SELECT c.conv_id, c.n + 1 AS pos, m.state, min(m.cost) AS cost, arg_min(m.edits, (m.cost, m.edits)) AS edits,
           arg_min(replace(m.lines, '|', chr(10)), (m.cost, m.edits)) AS lines
    FROM (SELECT DISTINCT conv_id, n FROM word) c, moves m WHERE m.letter = 'end' GROUP BY c.conv_id, c.n, m.state)
  UNION ALL
  SELECT b.conv_id, w.pos, m.state, min(m.cost + b.cost), arg_min(m.edits || b.edits, (m.cost + b.cost, m.edits || b.edits)),
         arg_min(replace(m.lines, '|', chr(10)) || CASE m.kind WHEN 'gone' THEN '' WHEN 'own' THEN w.role || ':' || w.text || chr(10)
                 ELSE m.kind || ':' || w.text || chr(10) END || b.lines, (m.cost + b.cost, m.edits || b.edits))
  FROM best b JOIN word w ON w.conv_id IS NOT DISTINCT FROM b.conv_id AND w.pos = b.pos - 1 JOIN moves m ON m.letter = w.letter AND m.next = b.state
  GROUP BY b.conv_id, w.pos, m.state),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv_id)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(b.cost, 0)::BIGINT AS cost, coalesce(b.edits, '') AS audit,
       sha256(CASE WHEN b.lines IS NULL OR b.lines = '' THEN '' ELSE left(b.lines, length(b.lines) - 1) END) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
     LEFT JOIN (SELECT * FROM best WHERE pos = 1 AND state = 0) b ON b.conv_id IS NOT DISTINCT FROM o.conv_id
"""

SQL: dict[str, str] = {"op11_repair": OP11_SQL, "op1_mixing": OP1_SQL, "op4_url_filter": OP4_SQL, "op13_merkle": OP13_SQL}
