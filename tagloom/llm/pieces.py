"""Encode texts piece by piece, each different piece once.

A tokenizer that first splits a text and then merges inside the parts gives the
same ids for a piece wherever it stands. Texts are cut where a blank is followed by
something that is not white space, and where a newline stands between two characters
that are not: there every splitting pattern in use starts a new part. The ids of a
piece are kept in a memo bounded by bytes.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

#: Bytes of each of the two generations of a memo; a matter of memory, not of results.
MEMO_BYTES = 96 << 20
#: Bytes of texts to encode at a time: enough that most units of one text are in others too. What Arrow
#: holds meanwhile is about ten times as much.
TEXT_BYTES = 6 << 20
#: What an entry takes besides its key and ids, and the longest key that is kept.
ENTRY_BYTES, LONGEST = 180, 64
IRREGULAR = re.compile(r" (?:\s|\Z)")
IRREGULAR_LINES = re.compile(r"\n(?:(?!\S)|(?<!\S\n))")
BETWEEN_LINES = re.compile(r"(?<=\S)\n(?=\S)")
#: ASCII marks that are neither letters, digits, blanks nor apostrophes.
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def units(text: str) -> list[str]:
    """Cut a text before every blank that something other than white space follows, and
    before every newline between two characters that are no white space.

    The first unit has no leading blank, others have lost theirs; a unit that
    begins with a newline had none.
    """
    if not IRREGULAR.search(text):
        if "\n" in text:
            text = BETWEEN_LINES.sub(" \n", text) if IRREGULAR_LINES.search(text) else text.replace("\n", " \n")
        return text.split(" ")
    first, *rest = text.split(" ")
    joined = [first]
    for unit in rest:
        if not unit or unit[0].isspace():
            joined[-1] += " " + unit
        else:
            joined.append(unit)
    return joined


def joins_marks(word: str) -> bool:
    """Whether ASCII marks behind a word are parts of their own.

    It has letters alone, none of which becomes a letter and a mark in lower case: that mark joins those behind it.
    """
    return word.isalpha() and (word.isascii() or word.lower().isalpha())


class Memo:
    """Ids of keys in two generations: when the newer is full it becomes the older, whose keys are
    taken over when they are used again and forgotten when they are not. Long keys are not kept."""

    def __init__(self, limit: int):
        self.limit, self.held = limit, 0
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def find(self, wanted: Sequence[str], learn: Callable[[list[str]], Sequence[bytes]]) -> dict[str, bytes]:
        """{key: ids} of different keys; what is not known is learned together."""
        return dict(zip(wanted, self.take(wanted, learn), strict=True))

    def take(self, wanted: Sequence[str], learn: Callable[[list[str]], Sequence[bytes]]) -> list[bytes]:
        """Ids of different keys in their order; what is not known is learned together."""
        found = list(map(self.new.get, wanted))
        absent = [at for at, ids in enumerate(found) if ids is None]
        if not absent:
            return found
        keys = [wanted[at] for at in absent]
        again = list(map(self.old.get, keys))
        learned = iter(learn([key for key, ids in zip(keys, again, strict=True) if ids is None]))
        again = [next(learned) if ids is None else ids for ids in again]
        for at, ids in zip(absent, again, strict=True):
            found[at] = ids
        sizes = list(map(len, keys))
        if max(sizes) > LONGEST:
            kept = [k for k, size in enumerate(sizes) if size <= LONGEST]
            keys, again, sizes = ([x[k] for k in kept] for x in (keys, again, sizes))
        self.new.update(zip(keys, again, strict=True))
        self.held += ENTRY_BYTES * len(keys) + 2 * sum(sizes) + sum(map(len, again))
        if self.held > self.limit:
            self.old, self.new, self.held = self.new, {}, 0
        return found


class PieceEncoder:
    """Ids of texts through memos of units.

    ``letters(words, led)`` encodes words of letters alone, with a blank before
    each if ``led``; ``whole`` encodes any text by the full rules. A unit of
    letters with marks behind them is its word and its marks, and a newline before
    it is encoded by itself; all other units are left to ``whole``.
    """

    def __init__(
        self,
        letters: Callable[[Sequence[str], bool], Sequence[bytes]],
        whole: Callable[[Sequence[str]], Sequence[bytes]],
        width: int = 4,
        memo_bytes: int = MEMO_BYTES,
    ):
        self.letters, self.whole, self.width = letters, whole, width
        self.known = Memo(memo_bytes)
        self.first, self.marks = Memo(memo_bytes // 8), Memo(memo_bytes // 8)
        self.newline = whole(["\n"])[0]

    def _learn(self, new: list[str]) -> list[bytes]:
        words = [unit for unit in new if unit.isalpha()]
        made = dict(zip(words, self.letters(words, True), strict=True))
        lined, odd = [], []  # (unit, word, marks), and units for the full rules
        for unit in new:
            if unit in made:
                continue
            core = unit.rstrip(MARKS) if unit[0] == "\n" else ""
            if joins_marks(core[1:]):
                lined.append((unit, core[1:], unit[len(core) :]))
            else:
                odd.append(unit)
        if lined:
            marks = self.marks.find(list({mark for *_, mark in lined}), self.whole)
            begun = list({word for _, word, _ in lined})
            ids = dict(zip(begun, self.letters(begun, False), strict=True))
            made.update((unit, self.newline + ids[word] + marks[mark]) for unit, word, mark in lined)
        made.update(zip(odd, self.whole([unit if unit[0] == "\n" else " " + unit for unit in odd]), strict=True))
        return list(map(made.__getitem__, new))

    def _units(self, names: pa.Array, used: np.ndarray) -> list[bytes]:
        """Ids of different units, nothing for those that are not used.

        Words with marks behind them are taken apart before the memo, which so
        holds each word once, whatever stands behind it.
        """
        cores = pc.utf8_rtrim(names, MARKS)
        units, made = names.to_numpy(zero_copy_only=False).tolist(), [b""] * len(names)
        led = used & (pc.binary_length(cores).to_numpy() < pc.binary_length(names).to_numpy())
        at = np.flatnonzero(led)
        words = cores.take(pa.array(at)).to_numpy(zero_copy_only=False).tolist()
        marked = [(k, word, units[k][len(word) :]) for k, word in zip(at.tolist(), words, strict=True) if joins_marks(word)]
        plain = used.copy()
        plain[[k for k, *_ in marked]] = False
        kept = np.flatnonzero(plain).tolist()
        wanted = [units[k] for k in kept]
        wanted += {word for _, word, _ in marked}.difference(wanted)
        ids = self.known.take(wanted, self._learn)
        for k, found in zip(kept, ids, strict=False):
            made[k] = found
        if marked:
            of = dict(zip(wanted, ids, strict=True))
            marks = self.marks.find(list({mark for *_, mark in marked}), self.whole)
            for k, word, mark in marked:
                made[k] = of[word] + marks[mark]
        return made

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian numbers of ``width`` bytes.

        Units are cut, told apart and put together again by Arrow; only the
        different units of these texts are looked up or learned here.
        """
        if not texts:
            return []
        lines, odd = [], []
        for at, text in enumerate(texts):
            if IRREGULAR.search(text):
                odd.append(at)
                text = ""
            elif "\n" in text:
                text = BETWEEN_LINES.sub(" \n", text) if IRREGULAR_LINES.search(text) else text.replace("\n", " \n")
            lines.append(text)
        made = self._joined(pc.split_pattern(pa.array(lines, pa.large_string()), " "))
        if odd:
            lists = pa.array([units(texts[at]) for at in odd], pa.list_(pa.large_string()))
            for at, ids in zip(odd, self._joined(lists), strict=True):
                made[at] = ids
        return made

    def _joined(self, cut: pa.ListArray) -> list[bytes]:
        """Ids of texts that are given as lists of units, one at least."""
        ends = cut.offsets.to_numpy().astype(np.int64)
        named = cut.values.dictionary_encode()
        names, place = named.dictionary, named.indices.to_numpy().astype(np.int64)
        begins = names.take(pa.array(place[ends[:-1]])).to_numpy(zero_copy_only=False).tolist()
        first = self.first.find(list(set(begins)), self.whole)
        place[ends[:-1]] = len(names)  # no ids here: the first unit's stand before the others'
        used = np.zeros(len(names) + 1, bool)
        used[place] = True
        values = pa.array([*self._units(names, used[:-1]), b""], pa.large_binary())
        taken = values.take(pa.array(place))
        _, offsets, data = taken.buffers()
        cuts = np.frombuffer(offsets, np.int64)[ends].tolist()
        ids = memoryview(data) if data is not None else b""
        return [first[begin] + ids[a:b] for begin, a, b in zip(begins, cuts, cuts[1:], strict=False)]


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies spell a byte: printable Latin-1 as it is, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}


@lru_cache(maxsize=4)
def library_encoder(path: str, narrow: bool = False) -> PieceEncoder:
    """Encoder by a file of the tokenizers library: its normaliser, splitter and merges, no special tokens.

    Ids have four bytes, or, if ``narrow``, two where the vocabulary allows.
    """
    tokenizer = Tokenizer.from_file(path)
    normalizer, splitter, model = tokenizer.normalizer, tokenizer.pre_tokenizer, tokenizer.model
    letters = _byte_letters()
    width = 2 if narrow and tokenizer.get_vocab_size() <= 1 << 16 else 4
    packed = [k.to_bytes(width, "little") for k in range(tokenizer.get_vocab_size())]
    lower = normalizer is not None
    with open(path, encoding="utf-8") as text:
        blank = "" if "Split" in json.dumps(json.load(text)["pre_tokenizer"]) else letters[32]

    def merge(part: str) -> bytes:
        return b"".join([packed[token.id] for token in model.tokenize(part)])

    def by_rules(text: str) -> bytes:
        plain = normalizer.normalize_str(text) if lower else text
        return b"".join([merge(part) for part, _ in splitter.pre_tokenize_str(plain)])

    def words(units: Sequence[str], led: bool) -> list[bytes]:
        made, before = [], blank if led else ""
        for unit in units:
            if unit.isascii():
                made.append(merge(before + (unit.lower() if lower else unit)))
            elif lower and not (plain := normalizer.normalize_str(unit)).isalpha():
                made.append(by_rules(unit))
            else:
                raw = (plain if lower else unit).encode().decode("latin-1")
                made.append(merge(before + raw.translate(letters)))
        return made

    # Ids of two bytes go to tasks that hold shards besides: half the memo.
    return PieceEncoder(words, lambda texts: [by_rules(text) for text in texts], width, MEMO_BYTES // (2 if narrow else 1))
