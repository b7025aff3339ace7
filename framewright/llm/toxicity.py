"""Toxicity of documents behind a noisy channel.

Writers hide words: letters become digits or signs, words are spaced out or dotted, letters repeat.  Every token with a look-alike, a filler or a
repeated sign is a lattice: each sign may stand for itself, for the letters it resembles, or for nothing, each repeat may be noise.  Viterbi
decoding under a character trigram model, counted over all documents, restores the likeliest letters.  Both the plain and the
restored words are then scored.

The scorer is a naive Bayes over words and word beginnings with conservative weights: the lower confidence bound of the log odds,
so a rare coincidence weighs little.  It learns from a bounded sample of labelled rows (``SAMPLE`` rows by hash order) and keeps
the ``FEATURES`` strongest.  Rows whose crc32 of the id leaves 1 by 3 are held out from learning.

Defined results: null and empty texts get the prior; null ids are scored, never learned from; ids labelled twice count as toxic if
one label says so; null labels are skipped; without labels of both kinds every score is the prior (0.5 with none at all);
repeated rows get equal scores; an empty table gives an empty result; other columns are ignored by :func:`scores` and
passed through by :func:`drop_toxic`.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewright.llm.common import as_bytes, as_text, stored

#: Labelled rows that the scorer learns from at most, and word features that it keeps at most.
SAMPLE, FEATURES = 40_000, 50_000
THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
#: Standard errors between an estimate and the weight that is used, and the least weight that counts.
CAUTION, LEAST_WEIGHT = 2.0, 1.5
#: Words of a text that count, and the log odds that a text loses per e-fold of different tokens beyond a typical number.
STRONGEST, TYPICAL, LENGTH_COST = 5, 200, 0.6
#: Lengths of the word beginnings that are features.
BEGINNINGS = (4, 5, 6)
#: What signs are written for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e", "£": "l",
}
#: Signs that may stand between the letters of a word.
FILLERS = ".-_*~'+^"
#: Costs of the channel in natural log units: a look-alike, a filler, a repeat in a run of two, a repeat in a longer run.
LOOKALIKE_COST, FILLER_COST, DOUBLE_COST, RUN_COST = 1.0, 1.0, 4.0, 0.5
#: Symbols of the character model: 0 for anything between words, a-z, and 32 classes of the bytes above 127.
SYMBOLS = 59
#: Bytes of a generation of a worker's memory of tokens, of which there are two, and what an entry takes besides its text.
MEMORY, ENTRY_BYTES = 16_000_000, 150
#: Counts that a task holds before it sends them on.
COUNTS = 100_000

_LETTERS = re.compile(r"[^\W\d_]+")
_SIGNS = re.escape("".join(LOOKALIKES) + FILLERS)
#: Any look-alike, filler or repeated sign, or a sign of another kind between two letters.
_HIDDEN = re.compile(rf"[{_SIGNS}]|(.)\1|[^\W\d_][^\w\s](?=[^\W\d_])")
_DOUBLED, _RUN = re.compile(r"(.)\1", re.DOTALL), re.compile(r"(.)\1+", re.DOTALL)
_SPREAD = re.compile(r"(?<!\S)(?:\S\s++){2,}\S(?!\S)")
_EDGES = ".,;:?\"()[]{}<>#%&"


def _symbols() -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    table[128:] = 27 + (np.arange(128, 256) & 31)
    return table


_SYMBOL = _symbols()


def _trigrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Character trigrams of a task's texts."""
    counts = np.zeros(SYMBOLS**3, np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            text = b"  ".join([b"", *as_bytes(batch["text"].slice(at, 500)), b""]).lower()
            for lo in range(0, len(text), 1 << 22):  # overlaps by two
                s = _SYMBOL[np.frombuffer(text[lo : lo + (1 << 22) + 2], np.uint8)]
                if len(s) > 2:
                    counts += np.bincount((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:], minlength=SYMBOLS**3)
    seen = np.flatnonzero(counts)
    yield pa.record_batch([seen, counts[seen]], names=["code", "n"])


def character_model(docs: DataFrame) -> np.ndarray:
    """Log probability of a symbol after two others, over all texts; at most ``SYMBOLS``³ counts reach the driver."""
    found = docs.select("text").mapInArrow(_trigrams, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SYMBOLS**3)
    counts[found["code"].to_numpy()] = found["n"].to_numpy()
    return trigram_model(counts.reshape(SYMBOLS, SYMBOLS, SYMBOLS))


def trigram_model(counts: np.ndarray) -> np.ndarray:
    """Trigram probabilities smoothed by bigrams, those by single symbols."""
    one = counts.sum((0, 1)) + 1
    one /= one.sum()
    two = counts.sum(0) + 5 * one
    two /= two.sum(1, keepdims=True)
    three = counts + 5 * two[None]
    return np.log(three / three.sum(2, keepdims=True))


def _emissions(letter: str) -> tuple[int, ...]:
    return tuple(int(_SYMBOL[b]) for b in letter.encode())


def restore(token: str, model: np.ndarray) -> str:
    """Likeliest letters behind a token.

    Only what lies between the first sign that can be read in several ways and the last one is decoded; letters before it are the same on all
    paths, and once the paths have met again behind it, so are those that follow.
    """
    loose = [i for i, sign in enumerate(token) if not sign.isalpha() or sign in LOOKALIKES or (i and token[i - 1] == sign)]
    if not loose:
        return token
    known = [0, 0, *_emissions(token[: loose[0]])]
    # a path is its score and a chain of (chain before, letter)
    paths: dict[tuple[int, int], tuple[float, tuple | None]] = {(known[-2], known[-1]): (0.0, None)}
    run, rest = 1, ""
    for i in range(loose[0], len(token)):
        if i > loose[-1] and len(paths) == 1:
            rest = token[i:]
            break
        sign = token[i]
        run = run + 1 if i and token[i - 1] == sign else 1
        long_run = run > 2 or (run == 2 and token[i + 1 : i + 2] == sign)
        choices: list[tuple[str, float]] = []
        if sign in LOOKALIKES:
            choices += [(letter, LOOKALIKE_COST) for letter in LOOKALIKES[sign]]
        elif sign.isalpha():
            choices.append((sign, 0.0))
        if sign in FILLERS or not choices:
            choices.append(("", FILLER_COST))
        if run > 1 and sign not in FILLERS:
            choices.append(("", RUN_COST if long_run else DOUBLE_COST))
        following: dict[tuple[int, int], tuple[float, tuple | None]] = {}
        for (a, b), (score, chain) in paths.items():
            for letter, cost in choices:
                x, y, total = a, b, score - cost
                for symbol in _emissions(letter):
                    total += model[x, y, symbol]
                    x, y = y, symbol
                held = following.get((x, y))
                if held is None or total > held[0]:
                    following[x, y] = total, (chain, letter) if letter else chain
        paths = following
    chain = max(((score + model[a, b, 0], chain) for (a, b), (score, chain) in paths.items()), key=lambda x: x[0])[1]
    letters = []
    while chain is not None:
        chain, letter = chain
        letters.append(letter)
    return token[: loose[0]] + "".join(reversed(letters)) + rest


def likely(word: str, model: np.ndarray) -> bool:
    """Whether the model finds the letters likelier than letters by chance."""
    symbols = [0, 0, *_emissions(word), 0]
    return sum(model[a, b, c] for a, b, c in zip(symbols, symbols[1:], symbols[2:])) > -math.log(SYMBOLS) * (len(symbols) - 2)


def token_words(token: str, model: np.ndarray) -> list[str]:
    """Words of a lower-case token, as written and restored.  A token without letters, such as a number, is a word only where the
    model finds its letters likely."""
    found = _LETTERS.findall(token)
    sign = token.strip(_EDGES)
    # "!" ends sentences and hides letters: both readings count
    for shown in {sign, sign.rstrip("!")} if _HIDDEN.search(sign) else ():
        restored = _LETTERS.findall(restore(shown, model))
        found += restored if _LETTERS.search(token) else [w for w in restored if likely(w, model)]
    return [w for w in found if len(w) > 2]


def tokens_of(text: str) -> set[str]:
    """Different lower-case tokens; letters that stand alone in a row also as one token."""
    text = text.lower()
    tokens = text.split()
    found = set(tokens)
    lone = list(map(len, tokens)).count(1) > 2  # only then letters can stand alone in a row
    for row in _SPREAD.findall(text) if lone else ():
        joined = "".join(row.split())
        if len(set(joined)) > 2:
            found.add(joined)
    return found


def features(word: str) -> list[str]:
    return [word, *[f"{word[:n]}+" for n in BEGINNINGS if len(word) > n]]


def neighbours(text: str) -> set[tuple[str, int]]:
    """Different tokens of a text, each with a mark of the token before it."""
    tokens = text.lower().split()
    found = {(t, zlib.crc32(p.encode()) & 0xFFFF) for p, t in zip(["", *tokens], tokens)}
    return found | {(t, 0) for t in tokens_of(text)}


class Recent:
    """What a worker found out about tokens: two generations, each bounded by bytes; what is still used moves to the younger one."""

    def __init__(self, find: Callable) -> None:
        self.find, self.young, self.old, self.size = find, {}, {}, 0

    def __call__(self, token: str):
        found = self.young.get(token)
        if found is None:
            found = self.old.get(token)
            if found is None:
                found = self.find(token)
            if self.size > MEMORY:
                self.young, self.old, self.size = {}, self.young, 0
            self.young[token] = found
            self.size += len(token) + ENTRY_BYTES + (sum(map(len, found)) + 60 * len(found) if isinstance(found, list) else 0)
        return found


def _counter(model: np.ndarray) -> Callable:
    """Texts per feature (neighbour -1), toxic ones also by the token before the word.  Feature ``''`` counts texts."""
    schema = pa.schema([("feature", pa.string()), ("neighbour", pa.int32()), ("toxic", pa.int64()), ("clean", pa.int64())])

    def flush(held: Counter, toxic: bool) -> pa.RecordBatch:
        names, marks = zip(*held) if held else ((), ())
        counts, none = pa.array(list(held.values()), pa.int64()), pa.array([0] * len(held), pa.int64())
        columns = [pa.array(names, pa.string()), pa.array(marks, pa.int32()), *((counts, none) if toxic else (none, counts))]
        return pa.record_batch(columns, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {True: Counter(), False: Counter()}
        named = Recent(lambda token: [f for w in token_words(token, model) for f in features(w)])
        for batch in batches:
            for text, toxic in zip(as_text(batch["text"]), batch["toxic"].to_pylist()):
                if toxic:
                    own = {(f, n) for t, n in neighbours(text) for f in named(t)}
                    own |= {(f, -1) for f, _ in own} | {("", -1), ("", zlib.crc32(text.encode()) & 0x7FFFFFFF)}
                else:
                    own = {(f, -1) for t in tokens_of(text) for f in named(t)} | {("", -1)}
                held[bool(toxic)].update(own)
                for kind, counter in held.items():
                    if len(counter) > COUNTS:
                        yield flush(counter, kind)
                        counter.clear()
        for kind, counter in held.items():
            yield flush(counter, kind)

    return run


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, model: np.ndarray, *, sample: int = SAMPLE, keep: int = FEATURES) -> tuple[float, dict[str, float]]:
    """Prior log odds and weights of word features."""
    chosen = labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL").filter(~held_out(F.col("doc_id")))
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    learned = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic")  # `sample` rows at most
    counts = learned.mapInArrow(_counter(model), "feature string, neighbour int, toxic long, clean long")
    counts = counts.groupBy("feature", "neighbour").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # copies of a text repeat a word beside the same neighbour: they are one piece of evidence
    texts = F.sum(F.when(F.col("neighbour") == -1, F.col("toxic")).otherwise(0))
    places = F.count_if((F.col("toxic") > 0) & (F.col("neighbour") > 0))
    counts = counts.groupBy("feature").agg(F.least(texts, places).alias("toxic"), F.sum("clean").alias("clean"))
    counts = counts.filter("toxic > 1 OR feature = ''")
    counts = stored(counts, "toxicity-features")
    total = counts.filter("feature = ''").first()
    toxic, clean = (total["toxic"], total["clean"]) if total else (0, 0)
    prior = math.log((toxic + 0.5) / (clean + 0.5))
    if not toxic or not clean:
        return prior, {}
    a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
    weight = F.log(a / (toxic + 1)) - F.log(b / (clean + 1)) - CAUTION * F.sqrt(1 / a + 1 / b)
    weighed = counts.filter("feature != ''").select("feature", "toxic", weight.alias("weight")).filter(F.col("weight") > LEAST_WEIGHT)
    best = weighed.orderBy((F.col("toxic") * F.col("weight")).desc(), "feature").limit(keep).toArrow()
    return prior, dict(zip(best["feature"].to_pylist(), best["weight"].to_pylist()))


def _squeezed(word: str) -> str:
    """The word with every run of a sign as one sign."""
    return _RUN.sub(r"\1", word) if _DOUBLED.search(word) else word


def weigher(weights: dict[str, float], model: np.ndarray) -> Callable[[str], float]:
    """Weight of a token: that of its strongest feature.

    Decoding drops repeats from a token of letters and nothing else, so its words and their beginnings, squeezed, begin as the squeezed token
    does.  Where no weighed feature begins like that the weight is 0, and nothing needs decoding.
    """
    squeezed = {_squeezed(feature.rstrip("+")) for feature in weights}
    openings = {s[:3] for s in squeezed}  # whole where a feature has fewer signs
    first = {s[:1] for s in squeezed}
    slow = Recent(lambda token: max((weights.get(f, 0.0) for w in token_words(token, model) for f in features(w)), default=0.0))

    def weigh(token: str) -> float:
        sign = token.strip(_EDGES)
        if sign.isalpha():
            if sign[0] not in first:
                return 0.0
            start = _squeezed(sign)[:3]
            if start not in openings and start[:2] not in openings and start[:1] not in openings:
                return 0.0
        return slow(token)

    return weigh


def evidence(text: str, weight_of: Callable[[str], float]) -> float:
    """The strongest words of a text: the first counts fully, the second half, the third a third and so on.  Long texts hold
    more words that are there by chance, so they need more."""
    tokens = tokens_of(text)
    found = [weight for weight in map(weight_of, tokens) if weight]
    found.sort(reverse=True)
    return sum(w / i for i, w in enumerate(found[:STRONGEST], 1)) - LENGTH_COST * max(0.0, math.log(max(1, len(tokens)) / TYPICAL))


def _scorer(shared) -> Callable:
    schema = pa.schema([("doc_id", pa.int64()), ("place", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        prior, weights, model = shared.value
        weight_of = weigher(weights, model)
        for batch in batches:
            scores = [1 / (1 + math.exp(-prior - evidence(t, weight_of))) for t in as_text(batch["text"])]
            yield pa.record_batch([batch["doc_id"], batch["place"], pa.array(scores, pa.float64())], schema=schema)

    return run


def scores(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD, sample: int = SAMPLE, keep: int = FEATURES) -> DataFrame:
    """One row per document: ``doc_id, place, held_out, score, predicted``; ``place`` is the row's number in the scan."""
    return _scores(docs.withColumn("_place", F.monotonically_increasing_id()), labels, threshold, sample, keep)


def _scores(docs: DataFrame, labels: DataFrame, threshold: float, sample: int = SAMPLE, keep: int = FEATURES) -> DataFrame:
    model = character_model(docs)
    prior, weights = learn(docs, labels, model, sample=sample, keep=keep)
    shared = docs.sparkSession.sparkContext.broadcast((prior, weights, model))
    placed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("_place").alias("place"), "text")
    found = placed.mapInArrow(_scorer(shared), "doc_id long, place long, score double")
    return found.select("doc_id", "place", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """Documents that the scorer doesn't reject, with all their columns."""
    # rows are numbered once and written: another scan may cut the files otherwise
    numbered = stored(docs.withColumn("_place", F.monotonically_increasing_id()), "toxicity-placed")
    places = _scores(numbered, labels, threshold).filter("predicted = 1").select(F.col("place").alias("_place"))
    return numbered.join(places, "_place", "left_anti").drop("_place")
