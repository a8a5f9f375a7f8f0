"""Language identification by interpolated Kneser-Ney models of characters.

Each language has a model of the letters in a word and of its end, given up to three
symbols before. Probabilities of the character n-grams seen and the backoff weights
of their contexts are stored as arrays sorted by a 64-bit hash; a lookup is a binary
search. A text gets the language whose model needs the fewest bits a symbol.

A word's bits depend on the word alone, so a task scores each word once and keeps it
in a memo bounded by bytes; a text is then a weighted sum over its words. Scoring has
no shuffle. Models are fitted on a bounded sample of whole texts, one group for each
language, spread evenly over the corpus by a hash of the text.

Another part of the sample calibrates: how large the lead over the second language is
where the first is right, and how many bits a language's own texts need at a given
length. Texts that need far more are rejected.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import SLICE, remainder, text_bytes
from tagloom.sources.storage import materialise

#: Letters with the marks on them; what a word is.
WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*+")
#: Symbols of an n-gram; contexts have one less.
ORDER = 4
#: Symbols before and behind a word.
BEGIN, END = 2, 3
#: Letters that the last interpolation spreads its mass over, about all that Unicode has.
ALPHABET = 150_000
#: Bytes of text that a language's model is fitted on, about, and of all languages together.
FIT_BYTES, ALL_FIT_BYTES = 1 << 20, 8 << 20
#: Languages with the most texts that are learned.
LANGUAGES = 256
#: Of so many parts of the sample one calibrates.
PARTS = 5
#: Bytes of a task's memo of words, and the longest word in it.
MEMO_BYTES, MEMO_WORD = 64 << 20, 24
#: Characters of texts that are scored at a time, and of words that are looked up at a time.
TEXT_CHARS, WORD_CHARS = 4 << 20, 1 << 18
#: A text is rejected this many deviations above what its language's own texts of that length need.
CEILING = 4.0
#: Texts of a length that a ceiling is drawn from, at least, and the least deviation that texts are held to have.
LEAST, DEVIATION = 20, 0.1
#: Lead of the only language, in bits.
ALONE = 64.0
UNKNOWN = "und"
FACTOR = np.uint64(0x9E3779B97F4A7C15)


# --- one language ----------------------------------------------------------


def symbols(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes of all words, each behind ORDER - 1 begins and before one end; symbols of each word with its end)."""
    head, tail = chr(BEGIN) * (ORDER - 1), chr(END)
    codes = np.frombuffer("".join([head + word + tail for word in words]).encode("utf-32-le"), np.uint32)
    return codes.astype(np.uint64), np.fromiter(map(len, words), np.int64, len(words)) + 1


def gram_hashes(codes: np.ndarray) -> list[np.ndarray]:
    """Hashes of the 1- to ORDER-grams that end at each place, by place."""
    made = [codes.copy()]
    for order in range(1, ORDER):
        longer = codes.copy()
        longer[order:] += made[-1][order - 1 : -1] * FACTOR  # the shorter gram one place before
        made.append(longer)
    return made


def discounts(counts: np.ndarray) -> np.ndarray:
    """Kneser-Ney discounts of counts 0, 1, 2 and 3 or more, from the counts of counts."""
    n1, n2, n3, n4 = (int((counts == k).sum()) for k in (1, 2, 3, 4))
    if not (n1 and n2 and n3 and n4):
        return np.array([0, 0.5, 0.75, 0.75])
    share = n1 / (n1 + 2 * n2)
    found = [1 - 2 * share * n2 / n1, 2 - 3 * share * n3 / n2, 3 - 4 * share * n4 / n3]
    return np.array([0, *(min(max(d, 0.1), 0.95 * (k + 1)) for k, d in enumerate(found))])


@dataclass(frozen=True)
class Table:
    """Values by hash; keys are sorted."""

    keys: np.ndarray
    values: np.ndarray

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which are there, values of those)"""
        place = np.searchsorted(self.keys, wanted)
        place[place == len(self.keys)] = 0
        known = self.keys[place] == wanted if len(self.keys) else np.zeros(len(wanted), bool)
        return known, self.values[place[known]]


@dataclass(frozen=True)
class CharModel:
    """``grams[k]``: log2 probability of (k + 1)-grams; ``contexts[k]``: log2 backoff weight of k-grams, k from 1."""

    grams: list[Table]
    contexts: list[Table]
    unknown: float

    def bits(self, codes: np.ndarray, hashes: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
        """Bits of each word with its end."""
        places = np.flatnonzero(codes != BEGIN)
        chance = np.full(len(places), self.unknown)
        for order, grams in enumerate(self.grams):
            known, found = grams.find(hashes[order][places])
            if order:
                missing = np.flatnonzero(~known)
                there, weight = self.contexts[order].find(hashes[order - 1][places[missing] - 1])
                chance[missing[there]] += weight
            chance[known] = found
        starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        return -np.add.reduceat(chance, starts)


def fit_model(counts: Counter) -> CharModel:
    """Interpolated Kneser-Ney model of words with their counts; there must be one.

    The longest grams go by their counts, shorter ones by how many different
    symbols stand before them, and those at the beginning of a word, which have
    only one, by their counts.
    """
    words = sorted(counts)
    codes, sizes = symbols(words)
    hashes = gram_hashes(codes)
    places = np.flatnonzero(codes != BEGIN)
    weights = np.repeat(np.fromiter((counts[w] for w in words), np.int64, len(words)), sizes)
    seen = []  # by order: keys, a place of each, times seen
    for order in range(ORDER):
        keys, at, inverse = np.unique(hashes[order][places], return_index=True, return_inverse=True)
        seen.append((keys, places[at], np.bincount(inverse, weights=weights).astype(np.int64)))
    grams, contexts = [], [Table(np.array([], np.uint64), np.array([], np.float32))]
    unknown, shorter = 0.0, None
    for order, (keys, at, times) in enumerate(seen):
        if order < ORDER - 1:
            longer = hashes[order][seen[order + 1][1]]
            before = np.bincount(np.searchsorted(keys, longer), minlength=len(keys))
            times = np.where(codes[at - order] == BEGIN, times, before)
        cut = discounts(times)[np.minimum(times, 3)]
        if order:
            known, group = np.unique(hashes[order - 1][at - 1], return_inverse=True)
            total = np.bincount(group, weights=times)
            left = np.bincount(group, weights=cut) / total
            place = np.searchsorted(seen[order - 1][0], hashes[order - 1][at])
            chance = (times - cut) / total[group] + left[group] * shorter[place]
            contexts.append(Table(known, np.log2(left).astype(np.float32)))
        else:
            left = cut.sum() / times.sum()
            unknown = math.log2(left / ALPHABET)
            chance = (times - cut) / times.sum() + left / ALPHABET
        shorter = chance
        grams.append(Table(keys, np.log2(chance).astype(np.float32)))
    return CharModel(grams, contexts, unknown)


# --- all languages ---------------------------------------------------------


def length_class(size: int) -> int:
    return size.bit_length() - 1


@dataclass
class Identifier:
    """Models of all languages in alphabetical order, and what calibration found."""

    languages: list[str]
    models: list[CharModel]
    slope: float = 2.0
    offset: float = 0.0
    #: (language or None for all, length class) -> mean and deviation of bits a symbol of its own texts
    usual: dict[tuple[str | None, int], tuple[float, float]] = field(default_factory=dict)

    def word_bits(self, words: Sequence[str]) -> np.ndarray:
        """(words, languages)"""
        made = np.empty((len(words), len(self.models)))
        start = 0
        while start < len(words):
            stop, chars = start, 0
            while stop < len(words) and (stop == start or chars < WORD_CHARS):
                chars += len(words[stop]) + ORDER
                stop += 1
            codes, sizes = symbols(words[start:stop])
            hashes = gram_hashes(codes)
            for k, model in enumerate(self.models):
                made[start:stop, k] = model.bits(codes, hashes, sizes)
            start = stop
        return made

    def judge(self, bits: np.ndarray, size: int) -> tuple[str, float, bool, float]:
        """(language, score, rejected, bits a symbol) of a text of ``size`` symbols."""
        best = int(np.argmin(bits))
        rate = bits[best] / size
        score = 1 / (1 + math.exp(-self.slope * math.log1p(self.lead(bits, best)) - self.offset))
        mean, deviation = self.usual.get((self.languages[best], length_class(size)), (0.0, math.inf))
        far = (rate - mean) / deviation
        return self.languages[best], min(1.0, score * min(1.0, CEILING / max(far, CEILING))), far > CEILING or score < 0.5, rate

    @staticmethod
    def lead(bits: np.ndarray, best: int) -> float:
        """By how many bits the best language is ahead of the second."""
        others = np.delete(bits, best)
        return float(others.min() - bits[best]) if len(others) else ALONE


class Reader:
    """Texts to their bits by language, through a memo of words bounded by bytes."""

    def __init__(self, identifier: Identifier, memo_bytes: int = MEMO_BYTES):
        self.identifier = identifier
        self.room = max(1, memo_bytes // (200 + 8 * len(identifier.models)))
        self.places: dict[str, int] = {}
        self.known = np.empty((0, len(identifier.models)))

    def bits(self, counted: Sequence[Counter]) -> Iterator[tuple[np.ndarray, int]]:
        """(bits by language, symbols) of texts given by the counts of their words."""
        wanted = set().union(*counted).difference(self.places)
        if len(self.places) + len(wanted) > self.room:
            self.places, self.known = {}, self.known[:0]
            wanted = set().union(*counted)
        new = sorted(wanted, key=lambda word: (len(word) > MEMO_WORD, word))
        kept = min(sum(len(word) <= MEMO_WORD for word in new), self.room)
        start = len(self.places)
        table = np.concatenate((self.known, self.identifier.word_bits(new))) if new else self.known
        places = self.places | dict(zip(new, range(start, start + len(new)), strict=True)) if len(new) > kept else self.places
        self.places.update(zip(new[:kept], range(start, start + kept), strict=True))
        self.known = table[: start + kept]
        for counts in counted:
            at = np.fromiter(map(places.__getitem__, counts), np.int64, len(counts))
            times = np.fromiter(counts.values(), np.float64, len(counts))
            size = sum((len(word) + 1) * n for word, n in counts.items())
            yield times @ table[at], size


def read_words(text: bytes | None) -> list[str]:
    return WORDS.findall(text.decode().lower()) if text else []


def text_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (a text last) whose texts together have at most about TEXT_CHARS bytes."""
    for batch in batches:
        start, held = 0, 0
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_pylist()
        for row, size in enumerate(sizes):
            if row > start and (held + size > TEXT_CHARS or row - start == SLICE):
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if start < batch.num_rows:
            yield batch.slice(start)


# --- learning --------------------------------------------------------------


def sample(rows: DataFrame, fit_bytes: int, all_bytes: int, languages: int) -> DataFrame:
    """A written table (lang, h, t) of different whole texts, about ``fit_bytes`` of each language.

    A text is in by its hash, so copies are in or out together and count once; the
    share of a language follows its different texts. All of a small one is in.
    """
    hashed = rows.select("lang", "t", F.xxhash64("t").alias("h"))
    sizes = hashed.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("t")).alias("bytes"), F.approx_count_distinct("h").alias("texts")
    )
    found = sizes.orderBy(F.desc("n"), "lang").limit(languages).collect()
    each = min(fit_bytes, all_bytes // max(len(found), 1))
    shares = {r["lang"]: min(1.0, each / max(1.0, r["bytes"] / r["n"] * r["texts"])) for r in found}
    if not shares:
        return materialise(hashed.limit(0), "languages")
    share = F.try_element_at(F.create_map(*[F.lit(x) for pair in shares.items() for x in pair]), F.col("lang"))
    draw = F.pmod(F.xxhash64("h"), F.lit(1 << 40)) / float(1 << 40)
    return materialise(hashed.filter(draw < share).groupBy("lang", "h").agg(F.min("t").alias("t")), "languages")


MODEL = "lang string, part int, keys binary, chances binary"


def _calibrates() -> Column:
    return F.pmod(F.shiftright("h", 8), F.lit(PARTS)) == 0


def fit_models(texts: DataFrame) -> Identifier:
    """One model for each language of the sample's fitting part that has a word; one group each."""

    def run(batch: pa.Table) -> pa.Table:
        counts: Counter = Counter()
        for text in batch["t"].to_pylist():
            counts.update(read_words(text))
        rows = []
        if counts:
            model = fit_model(counts)
            tables = [*model.grams, *model.contexts, Table(np.array([], np.uint64), np.array([model.unknown], np.float64))]
            rows = [(batch["lang"][0].as_py(), k, t.keys.tobytes(), t.values.tobytes()) for k, t in enumerate(tables)]
        columns = list(zip(*rows, strict=True)) or [[], [], [], []]
        types = (pa.string(), pa.int32(), pa.binary(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["lang", "part", "keys", "chances"])

    stored: dict[str, list] = {}
    for r in texts.groupBy("lang").applyInArrow(run, MODEL).orderBy("lang", "part").collect():
        kind = np.float32 if r["part"] < 2 * ORDER else np.float64
        stored.setdefault(r["lang"], []).append(Table(np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["chances"], kind)))
    models = [CharModel(t[:ORDER], t[ORDER:-1], float(t[-1].values[0])) for t in stored.values()]
    return Identifier(list(stored), models)


def windows(words: list[str]) -> Iterator[list[str]]:
    """Pieces of 1, 2, 4 ... words, one after another, and the whole."""
    start, size = 0, 1
    while start + size < len(words):
        yield words[start : start + size]
        start, size = start + size, size * 2
    if words:
        yield words


def calibrated(identifier: Identifier, texts: DataFrame) -> Identifier:
    """The identifier with what (lang, t) rows show: sums by lead, and by language and length, reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, sums = Reader(identifier), Counter()
        order = {lang: k for k, lang in enumerate(identifier.languages)}
        for batch in text_groups(batches):
            for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if lang not in order:
                    continue
                for bits, size in reader.bits([Counter(w) for w in windows(read_words(text))]):
                    best = int(np.argmin(bits))
                    lead = int(4 * math.log1p(identifier.lead(bits, best)))
                    sums[None, lead, "n"] += 1
                    sums[None, lead, "sum"] += best == order[lang]
                    rate = bits[order[lang]] / size
                    for name, value in (("n", 1.0), ("sum", rate), ("squares", rate * rate)):
                        sums[lang, length_class(size), name] += value
        if sums:
            langs, bins, names = zip(*sums, strict=True)
            arrays = [pa.array(langs, pa.string()), pa.array(bins, pa.int32()), pa.array(names), pa.array(list(sums.values()), pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["lang", "bin", "name", "value"])

    summed = texts.select("lang", "t").mapInArrow(run, "lang string, bin int, name string, value double")
    rows = summed.groupBy("lang", "bin", "name").agg(F.sum("value").alias("value")).collect()
    found = {(r["lang"], r["bin"], r["name"]): r["value"] for r in rows}
    return _with_calibration(identifier, found)


def _with_calibration(identifier: Identifier, found: dict) -> Identifier:
    leads = sorted(b for lang, b, name in found if lang is None and name == "n")
    slope, offset = identifier.slope, identifier.offset
    if leads:
        n = np.array([found[None, b, "n"] for b in leads])
        right = np.array([found.get((None, b, "sum"), 0.0) for b in leads])
        slope, offset = logistic((np.array(leads) + 0.5) / 4, right + 1, n + 2)
    sums: Counter = Counter()
    for (lang, size, name), value in found.items():
        if lang is not None:
            sums[lang, size, name] += value
            sums[None, size, name] += value
    usual = {}
    for lang in (None, *identifier.languages):
        own = None  # of the longest class so far that has enough texts
        for size in range(64):
            n = sums[lang, size, "n"]
            if n >= LEAST:
                mean = sums[lang, size, "sum"] / n
                own = mean, max(math.sqrt(max(sums[lang, size, "squares"] / n - mean * mean, 0.0)), DEVIATION)
            if used := own or usual.get((None, size)):
                usual[lang, size] = used
    return Identifier(identifier.languages, identifier.models, slope, offset, usual)


def logistic(x: np.ndarray, right: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """(slope, offset) of the chance of being right by Newton steps, a little regularised; the slope is not negative."""
    at = np.array([1.0, 0.0])
    inputs = np.stack((x, np.ones(len(x))), axis=1)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(inputs @ at, -30, 30)))
        slope = inputs.T @ (right - n * chance) - 0.01 * at
        bend = (inputs * (n * chance * (1 - chance))[:, None]).T @ inputs + 0.01 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        at = at + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return max(float(at[0]), 0.0), float(at[1])


def fit(
    docs: DataFrame, *, lang: str = "lang", text: str = "text", fit_bytes: int = FIT_BYTES,
    all_bytes: int = ALL_FIT_BYTES, languages: int = LANGUAGES,
) -> Identifier:
    """Models and calibration from texts with a language.

    Rows with a null text or language teach nothing. About ``fit_bytes`` of
    different whole texts a language are read, ``all_bytes`` of all together, of
    the ``languages`` most frequent ones; four fifths fit, the rest calibrate. A
    language with one text is fitted on it. Without usable rows nothing is
    learned: the identifier has no languages.
    """
    named = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").cast("binary").alias("t"))
    texts = sample(named.filter(F.col("lang").isNotNull() & F.col("t").isNotNull()), fit_bytes, all_bytes, languages)
    fitting = texts.filter(~_calibrates())
    # Languages whose few texts all fell to the calibrating part are fitted on those.
    few = texts.join(F.broadcast(fitting.select("lang").distinct()), "lang", "left_anti")
    identifier = fit_models(fitting.unionByName(few))
    return calibrated(identifier, texts.filter(_calibrates())) if identifier.languages else identifier


def identify(docs: DataFrame, identifier: Identifier, *, key: str = "doc_id", text: str = "text", keep: Sequence[Column] = ()) -> DataFrame:
    """(key, ..., lang_pred, score, rejected, cross_entropy), one row per input row; no shuffle.

    ``lang_pred`` is the language whose model needs the fewest bits a symbol, of
    equal ones the first in the alphabet; ``und`` for a text that is null or has no
    letter, and for all texts if nothing was learned: their score is 0, they are
    rejected, and their cross-entropy is null. ``score`` is the calibrated chance
    that it is right, lowered for a text that needs far more bits than its
    language's own; ``rejected`` if that is more than ``CEILING`` deviations, or if
    the chance is below a half. Repeated rows and null keys are rows like others.
    """
    columns = docs.select(F.col(key).alias("k"), *keep, text_bytes(text).alias("t"))
    given = [f"{f.name} {f.dataType.simpleString()}" for f in columns.schema.fields[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(identifier)
        for batch in text_groups(batches):
            counted = [Counter(read_words(text)) for text in batch.column(batch.num_columns - 1).to_pylist()]
            found = reader.bits([c for c in counted if c]) if identifier.languages else iter(())
            judged = [identifier.judge(*next(found)) if c and identifier.languages else (UNKNOWN, 0.0, True, None) for c in counted]
            langs, scores, rejected, rates = (list(c) for c in zip(*judged, strict=True))
            arrays = [*batch.columns[:-1], pa.array(langs), pa.array(scores, pa.float64()), pa.array(rejected), pa.array(rates, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], "lang_pred", "score", "rejected", "cross_entropy"])

    made = columns.mapInArrow(run, ", ".join([*given, "lang_pred string", "score double", "rejected boolean", "cross_entropy double"]))
    return made.withColumnRenamed("k", key)


def classify(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``identify`` for all rows, learned from those that are not held out: crc32 of the key modulo 4 is not 2."""
    held_out = remainder(key, 4) == 2
    identifier = fit(docs.filter(~held_out), lang=lang, text=text)
    return identify(docs, identifier, key=key, text=text, keep=[held_out.alias("held_out")])
