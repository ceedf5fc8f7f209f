"""Toxicity by a weighted finite-state grammar over clauses, with words and weights learned from labelled documents."""

from __future__ import annotations

import functools
import hashlib
import heapq
import math
import re
from collections import Counter
from collections.abc import Callable, Hashable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from quayside.session import settle, ship_package

#: Labelled documents of each class the model is fitted on, in hash order. Everything else sees all documents.
FIT_TOXIC, FIT_CLEAN = 4_000, 8_000
#: A learned word or stem stands in this many toxic fit documents, and in so much larger a share of them than of clean ones.
LEAST_DOCUMENTS, LEAST_SHARE = 5, 0.9
#: Learned terms: each must still explain some documents that fewer than COVER earlier terms explain.
COVER, LEAST_GAIN = 4, 3
STEMS = (4, 5)
CACHE_WORDS = 500_000

# Word classes that are known without labels, in four languages.
INSULTS = frozenset(
    "idiot idiots stupid moron morons loser losers scum trash worthless pathetic disgusting clown imbecile dumbass "
    "idioten dumm trottel abschaum wertlos imbécile imbéciles crétin débile ordure idiota idiotas estúpido estúpida imbécil basura".split()
)
# Insults of several words: a heap of something worthless, and a mouth that is to be shut.
HEAPS = frozenset("piece pieces sack pile stück haufen sack morceau tas pedazo pedazos montón saco".split())
DIRT = frozenset("crap shit garbage filth dung scheiße dreck mist merde fumier mierda estiércol".split())
SHUTS = frozenset("shut halt haltet ferme fermez cierra cierren".split())
MOUTHS = frozenset("mouth mouths trap maul fresse klappe gueule gueules pico hocico".split())
# Threats are a verb of harm behind an intent or with its victim.
INTENTS = frozenset("will gonna going shall ll must werde werden wird vais va allons voy vamos".split())
ATTACKS = frozenset("kill hurt destroy murder stab shoot umbringen töten verletzen tuer frapper détruire matar golpear destruir".split())
TARGETS = frozenset("you your yours du dich dir ihr euch dein deine toi tu te vous ton ta tú usted ustedes vosotros".split())
NEGATIONS = frozenset("not never no nobody isn aren wasn don nicht nie kein keine keinen ne pas jamais nunca jamás".split())
REPORTS = frozenset(
    "said says wrote writes called quoted claimed alleged reported according sagte schrieb laut zitierte dit écrit selon dijo escribió según".split()
)

_WORD = re.compile(r"[^\W\d_]+")
_CLAUSE = re.compile(r"[.!?;:\n|]+")

# Symbols: what a word is (INSULT to REPORT), the end of a clause, and what the machines make of them.
OTHER, INSULT, HEAP, DIRTY, SHUT, MOUTH, INTENT, ATTACK, TARGET, NEGATION, REPORT, END = ".IHDSMWAYNR$"
THREAT, AIMED_INSULT, AIMED_THREAT, DENIED, REPORTED = "VJUnq"
WORDS = (OTHER, INSULT, HEAP, DIRTY, SHUT, MOUTH, INTENT, ATTACK, TARGET, NEGATION, REPORT, END)
ALPHABET = (*WORDS, THREAT, AIMED_THREAT, DENIED, REPORTED)
#: Matches that count, in their order everywhere.
EVENTS = (INSULT, AIMED_INSULT, THREAT, AIMED_THREAT, DENIED, REPORTED)
#: Words that end some match; a text without them has none.
ENDS = frozenset((INSULT, DIRTY, MOUTH, ATTACK))
#: Words that a phrase, a negation, a target or intent, and a bare verb of harm reach.
PHRASE, SCOPE, REACH, GRASP = 2, 3, 4, 2


@dataclass(frozen=True)
class Transducer:
    """A sequential transducer over ``ALPHABET``: ``arcs[state][symbol] = (next state, output)``, starting in state 0."""

    arcs: tuple[Mapping[str, tuple[int, str]], ...]

    def step(self, state: int, symbol: str) -> tuple[int, str]:
        return self.arcs[state][symbol]


def tabulate(start: Hashable, move: Callable[[Hashable, str], tuple[Hashable, str]], alphabet: Sequence[str] = ALPHABET) -> Transducer:
    """The transducer of the states that ``move`` reaches from ``start``."""
    numbers, todo, arcs = {start: 0}, [start], []
    for state in todo:
        row = {}
        for symbol in alphabet:
            after, out = move(state, symbol)
            if after not in numbers:
                numbers[after] = len(numbers)
                todo.append(after)
            row[symbol] = (numbers[after], out)
        arcs.append(row)
    return Transducer(tuple(arcs))


def insults() -> Transducer:
    """Single insulting words stay; a heap with dirt, or a shutting with a mouth, within ``PHRASE`` words becomes an insult.

    States are the opening word and how many words it still reaches.
    """
    closing = {HEAP: DIRTY, SHUT: MOUTH}

    def move(state, symbol):
        opened, left = state
        if symbol in closing:
            return (symbol, PHRASE), OTHER
        if left and symbol == closing[opened]:
            return (OTHER, 0), INSULT
        down = (opened, left - 1) if left > 1 else (OTHER, 0)
        return down, symbol if symbol not in closing.values() else OTHER

    return tabulate((OTHER, 0), move)


def threats() -> Transducer:
    """A verb of harm within ``REACH`` words after an intent is a threat, aimed if its victim stands between; a bare verb stays.

    States are how many words the intent still reaches, and whether a target was met since.
    """

    def move(state, symbol):
        left, met = state
        if symbol == INTENT:
            return (REACH, False), OTHER
        down = (left - 1, met or symbol == TARGET) if left > 1 else (0, False)
        if symbol == ATTACK and left:
            return down, AIMED_THREAT if met else THREAT
        return down, symbol

    return tabulate((0, False), move)


def negation() -> Transducer:
    """Insults, threats and verbs of harm within ``SCOPE`` words after a negation are denied."""

    def move(left, symbol):
        if symbol == NEGATION:
            return SCOPE, OTHER
        denied = left and symbol in (INSULT, THREAT, AIMED_THREAT, ATTACK)
        return max(0, left - 1), DENIED if denied else symbol

    return tabulate(0, move)


def reported_speech() -> Transducer:
    """After a reporting word, insults and threats up to the end of the clause are someone else's."""

    def move(reported, symbol):
        if symbol == REPORT:
            return True, OTHER
        if reported and symbol in (INSULT, THREAT, AIMED_THREAT, DENIED):
            return True, REPORTED
        return reported, OTHER if reported and symbol == ATTACK else symbol

    return tabulate(False, move)


def aiming() -> Transducer:
    """Insults up to ``REACH`` words after a target or before one, and threats before one, are aimed.

    States are what waits for a target (nothing, an insult, a threat, a bare verb of harm) and how many words that, or with
    nothing waiting the last target, still reaches. What waits in vain comes out as it is, a bare verb not at all.
    """
    aimed = {INSULT: AIMED_INSULT, THREAT: AIMED_THREAT, ATTACK: AIMED_THREAT}
    in_vain = {OTHER: "", INSULT: INSULT, THREAT: THREAT, ATTACK: ""}

    def move(state, symbol):
        waiting, left = state
        if symbol == TARGET:
            return (OTHER, REACH), aimed.get(waiting, OTHER)
        if symbol == END:
            return (OTHER, 0), in_vain[waiting] or OTHER
        if symbol == INSULT and waiting == OTHER and left:
            return (OTHER, left - 1), AIMED_INSULT
        if symbol in aimed:
            return (symbol, GRASP if symbol == ATTACK else REACH), in_vain[waiting] or OTHER
        if waiting != OTHER and left == 1:
            return (OTHER, 0), in_vain[waiting] + symbol
        return (waiting, max(0, left - 1)), symbol

    return tabulate((OTHER, 0), move)


def compose(first: Transducer, second: Transducer) -> Transducer:
    """One transducer that does what ``second`` makes of the output of ``first``, which gives one symbol for each."""

    def move(pair, symbol):
        after, between = first.step(pair[0], symbol)
        last, out = second.step(pair[1], between)
        return (after, last), out

    return tabulate((0, 0), move)


@functools.cache
def grammar() -> Transducer:
    return functools.reduce(compose, (insults(), threats(), negation(), reported_speech(), aiming()))


def clause_events(symbols: str) -> Counter:
    """Matches of one clause given as word classes."""
    machine, state, seen = grammar(), 0, Counter()
    for symbol in symbols + END:
        state, out = machine.step(state, symbol)
        seen.update(out)
    return seen


#: The score of a text with one match that is not aimed stays so far below the threshold, and one that is aimed so far above it (logits).
THRESHOLD = 0.3
MARGIN = 0.05
_LIMIT = math.log(THRESHOLD / (1 - THRESHOLD)) - MARGIN
#: What the fit starts from and stays near without labels: weights of all matches, of those not denied or reported, of aimed
#: ones beyond the least, of aimed threats; and how far a lone match stays below the limit.
PRIOR = (0.8, 2.2, 1.0, 0.5, 0.1)


def features(found: Sequence[int]) -> tuple[float, ...]:
    """Each holds the next: matches, those not denied or reported, those aimed, those aimed that threaten."""
    n = dict(zip(EVENTS, found, strict=True))
    aimed = n[AIMED_INSULT] + n[AIMED_THREAT]
    open_ = n[INSULT] + n[THREAT] + aimed
    return tuple(map(math.log1p, (open_ + n[DENIED] + n[REPORTED], open_, aimed, n[AIMED_THREAT])))


def _weights(free: Sequence[float]) -> tuple[tuple[float, ...], float]:
    """Weights and constant from parameters that need only be non-negative.

    As features hold each other, a match that is aimed never weighs less than one that is not, and that never less than a denied
    or reported one. One match that is not aimed stays below the threshold, one that is aimed reaches it.
    """
    every, open_, beyond, threat, below = map(float, free)
    one = math.log(2)
    return (every, open_, (below + 2 * MARGIN) / one + beyond, threat), _LIMIT - one * (every + open_) - below


DEFAULT_WEIGHTS, DEFAULT_BIAS = _weights(PRIOR)


@dataclass(frozen=True)
class Model:
    """Learned words and stems with the weights of the events; small enough to travel with each task."""

    words: frozenset[str]
    stems: frozenset[str]
    weights: tuple[float, ...] = DEFAULT_WEIGHTS
    bias: float = DEFAULT_BIAS

    def classify(self, word: str) -> str:
        if word in INSULTS or word in self.words or any(word[:n] in self.stems for n in STEMS if len(word) > n):
            return INSULT
        return _known().get(word, OTHER)


@functools.cache
def _known() -> dict[str, str]:
    classes = {HEAP: HEAPS, DIRTY: DIRT, SHUT: SHUTS, MOUTH: MOUTHS, INTENT: INTENTS, ATTACK: ATTACKS, TARGET: TARGETS, NEGATION: NEGATIONS, REPORT: REPORTS}
    return {word: symbol for symbol, words in classes.items() for word in words}


class _Classes(dict):
    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> str:
        if len(self) >= CACHE_WORDS:
            self.clear()
        symbol = self[word] = self.model.classify(word)
        return symbol


@functools.cache
def _classes(model: Model) -> _Classes:
    return _Classes(model)


def events(text: str, model: Model) -> tuple[int, ...]:
    """Counts of the events over all clauses of a whole text."""
    known = _classes(model)
    text = text.lower()
    symbols = "".join(map(known.__getitem__, _WORD.findall(text)))
    if ENDS.isdisjoint(symbols):
        return (0,) * len(EVENTS)
    total: Counter = Counter()
    for clause in _CLAUSE.split(text):
        total += clause_events("".join(map(known.__getitem__, _WORD.findall(clause))))
    return tuple(total[e] for e in EVENTS)


def score(found: Sequence[int], model: Model) -> float:
    logit = model.bias + sum(w * x for w, x in zip(model.weights, features(found), strict=True))
    return 1 / (1 + math.exp(-min(50.0, max(-50.0, logit))))


def held_out(key: str) -> Column:
    """Rows no label is learned from: crc32 of the key as text, modulo 4, is 2. A null key is not held out."""
    return F.coalesce(F.crc32(F.encode(F.col(key).cast("string"), "UTF-8")) % 4 == 2, F.lit(False))


def _terms(text: str) -> set[str]:
    """Distinct words, and stems marked by a following hyphen."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:n] + "-" for w in words for n in STEMS if len(w) > n}


def _term_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of ``(text, toxic)`` rows for each term, and a digest of the toxic texts that hold it, combined by exclusive or."""
    for batch in batches:
        toxic, clean, low, high = Counter(), Counter(), Counter(), Counter()
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            terms = _terms(text or "")
            (toxic if label else clean).update(terms)
            if label:
                mark = hashlib.blake2b((text or "").encode("utf-8", "surrogatepass"), digest_size=16).digest()
                first, second = (int.from_bytes(half, "little", signed=True) for half in (mark[:8], mark[8:]))
                for term in terms:
                    low[term] ^= first
                    high[term] ^= second
        terms = list(toxic.keys() | clean.keys())
        counts = {name: pa.array([c[t] for t in terms], pa.int64()) for name, c in (("n_toxic", toxic), ("n_clean", clean), ("low", low), ("high", high))}
        yield pa.RecordBatch.from_pydict({"term": pa.array(terms, pa.string()), **counts})


def fit_rows(docs: DataFrame, labels: DataFrame, text: str, key: str, label: str) -> DataFrame:
    """``(text, toxic)`` of the labelled documents to fit on: at most ``FIT_TOXIC`` and ``FIT_CLEAN`` keys, each text once."""
    usable = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(key))
    usable = usable.groupBy(F.col(key).alias("k")).agg(F.max(label).cast("int").alias("toxic"))
    chosen = [usable.where(c).orderBy(F.xxhash64("k"), "k").limit(n) for c, n in (("toxic = 1", FIT_TOXIC), ("toxic = 0", FIT_CLEAN))]
    bounded = chosen[0].unionByName(chosen[1])  # at most FIT_TOXIC + FIT_CLEAN rows of two numbers
    found = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(bounded), "k")
    return found.select("text", "toxic").dropDuplicates(["text"])


def choose_terms(holding: Sequence[frozenset[str]], share: Mapping[str, float]) -> list[str]:
    """Terms that explain the toxic documents between them, the most telling first.

    Copies of one document share many words that mean nothing; these stop being chosen once their documents are explained by
    terms that stand in many more. Gains only fall, so a heap of earlier gains finds the best term.
    """
    lacks = [COVER] * len(holding)
    where: dict[str, list[int]] = {}
    for i, terms in enumerate(holding):
        for t in terms:
            where.setdefault(t, []).append(i)

    def gain(term: str) -> float:
        return sum(lacks[i] for i in where[term]) * share[term] ** 2

    names = sorted(where, key=lambda t: (t.endswith("-"), t), reverse=True)
    heap = [(-gain(t), rank) for rank, t in enumerate(names)]
    heapq.heapify(heap)
    chosen: list[str] = []
    while heap:
        before, rank = heapq.heappop(heap)
        now = -gain(names[rank])
        if now > before:
            if now < 0:
                heapq.heappush(heap, (now, rank))
            continue
        if -now < LEAST_GAIN * COVER / 2:
            break
        chosen.append(names[rank])
        for i in where[names[rank]]:
            lacks[i] = max(0, lacks[i] - 1)
    return chosen


def _fit_weights(rows: Sequence[tuple[tuple[int, ...], int, int]]) -> tuple[tuple[float, ...], float]:
    """Ridge logistic regression around ``PRIOR`` over (events, toxic, documents), one non-negative parameter after the other."""
    f = np.array([features(e) for e, _, _ in rows])
    y, n = np.array([t for _, t, _ in rows], float), np.array([c for _, _, c in rows], float)
    one = math.log(2)
    x = np.column_stack([f[:, 0] - one, f[:, 1] - one, f[:, 2], f[:, 3], f[:, 2] / one - 1])
    fixed = _LIMIT + f[:, 2] * 2 * MARGIN / one
    prior = np.array(PRIOR)
    free = prior.copy()
    for _ in range(500):
        start = free.copy()
        for j in range(len(free)):
            p = 1 / (1 + np.exp(-np.clip(fixed + x @ free, -30, 30)))
            slope = (n * (y - p)) @ x[:, j] - 0.5 * (free[j] - prior[j])
            curve = (n * p * (1 - p)) @ x[:, j] ** 2 + 0.5
            free[j] = max(0.0, free[j] + min(1.0, max(-1.0, slope / curve)))
        if np.abs(free - start).max() < 1e-7:
            break
    return _weights(free)


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", label: str = "toxic") -> Model:
    """A model from labelled documents outside the held-out part. Without toxic labels the known words and weights remain.

    Of the terms that stand in the same toxic fit documents only the ``COVER`` most telling are candidates: once these are chosen
    the documents need no further term, so no choice is lost. The driver gets the candidates that each fit document holds,
    bounded by the fit documents, and one row for each distinct combination of events.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = settle(fit_rows(docs, labels, text, key, label), "fit")
    sums = {r.toxic: r.n for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_clean = sums.get(1, 0), sums.get(0, 0)
    if not n_toxic:
        return Model(frozenset(), frozenset())
    spread = rows.repartition(spark.sparkContext.defaultParallelism)
    counted = spread.mapInArrow(_term_task, "term string, n_toxic long, n_clean long, low long, high long")
    share = (F.col("n_toxic") / n_toxic) / (F.col("n_toxic") / n_toxic + (F.col("n_clean") + 0.5) / (n_clean + 1))
    same_texts = Window.partitionBy("n_toxic", "low", "high").orderBy(F.desc("share"), F.col("term").endswith("-").desc(), F.desc("term"))
    telling = (
        counted.groupBy("term")
        .agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"), F.bit_xor("low").alias("low"), F.bit_xor("high").alias("high"))
        .withColumn("share", share)
        .where((F.col("n_toxic") >= LEAST_DOCUMENTS) & (F.col("share") >= LEAST_SHARE))
        .withColumn("place", F.row_number().over(same_texts))
        .where(F.col("place") <= COVER)
    )
    shares = {r.term: r.share for r in telling.collect()}

    def holding(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pydict(
                {"terms": pa.array([sorted(_terms(t or "") & shares.keys()) for t in batch.column(0).to_pylist()], pa.list_(pa.string()))}
            )

    held = rows.where("toxic = 1").select("text").mapInArrow(holding, "terms array<string>").collect()
    chosen = choose_terms(sorted((frozenset(r.terms) for r in held), key=sorted), shares)
    bare = Model(frozenset(t for t in chosen if t[-1] != "-"), frozenset(t[:-1] for t in chosen if t[-1] == "-"))
    seen = with_events(spread, bare, "text").groupBy("events", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    weights, bias = _fit_weights(sorted((tuple(r.events), r.toxic, r.n) for r in seen))
    return Model(bare.words, bare.stems, weights, bias)


def with_events(docs: DataFrame, model: Model, text: str, name: str = "events") -> DataFrame:
    @pandas_udf("array<int>")
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series([list(events(t, model)) for t in texts], dtype=object)

    return docs.withColumn(name, found(F.coalesce(F.col(text), F.lit(""))))


def with_toxicity(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1 for each whole text; only the text is looked at.

    Null and empty texts get the score of a text without events. Repeated rows are scored each, an empty table stays empty, and
    a column already called ``name`` is replaced. Nothing is shuffled.
    """
    ship_package(docs.sparkSession)

    @pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([score(events(t, model), model) for t in texts], dtype="float64")

    return docs.withColumn(name, scored(F.coalesce(F.col(text), F.lit(""))))
