"""BPE, shards and packing against the libraries and exact round trips."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tagloom.llm import bpe, packing, pieces, shards
from tagloom.llm.catalog import QUERIES
from tagloom.llm.common import by_size
from tagloom.sources.storage import scratch_path

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")
TEXTS = st.text(alphabet=st.sampled_from("abcdefghijklmnopqrstuvwxyzABZ  \n\t'.,!?éß漢ñ́　\x1c\x850９😀İ"), max_size=60)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def library(path):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def ids_of(raw: bytes) -> list[int]:
    return np.frombuffer(raw, "<u4").tolist()


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXTS, max_size=6))
def test_encoders_equal_the_libraries(texts):
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    known = test_encoders_equal_the_libraries.__dict__.setdefault(
        "known", (tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), library(BYTES), library(WORDS))
    )
    made = bpe.encoder_of(RANKS, public_tokenizers.PATTERN).encode(texts)
    assert [ids_of(x) for x in made] == [known[0].encode_ordinary(x) for x in texts]
    for path, tokenizer in zip((BYTES, WORDS), known[1:], strict=True):
        made = pieces.library_encoder(path).encode(texts)
        assert [ids_of(x) for x in made] == [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=70), min_size=1, max_size=8))
def test_trees_together_equal_single_trees(raw):
    ranks = bpe.ranks_of(RANKS)
    assert ranks.encode(raw) == [ranks.whole.get(x) or ranks.encode_long(x) for x in raw]
    assert [ranks.decode(x) for x in ranks.encode(raw)] == raw


def small_encoder(path, memo_bytes):
    made = pieces.library_encoder(path)
    return pieces.PieceEncoder(made.letters, made.whole, memo_bytes=memo_bytes)


def test_memo_starts_anew_without_changing_ids():
    small = small_encoder(WORDS, 2000)
    texts = [f"some words {k} and more,\n{k * 7} than it\nholds" for k in range(50)]
    made = [x for k in range(0, 50, 5) for x in small.encode(texts[k : k + 5])]
    assert made == pieces.library_encoder(WORDS).encode(texts)


def test_narrow_ids_are_the_same():
    texts = ["some words,\nand more", "", "1 2 3\n\n4", "é\nü"]
    wide, narrow = (pieces.library_encoder(BYTES, n).encode(texts) for n in (False, True))
    assert [np.frombuffer(x, "<u2").tolist() for x in narrow] == [ids_of(x) for x in wide]


def test_memo_keeps_two_generations():
    memo, learned = pieces.Memo(3 * (pieces.ENTRY_BYTES + 5)), []

    def learn(keys):
        learned.extend(keys)
        return [key.encode() for key in keys]

    for key in "abcdaefgahijab":
        assert memo.find([key], learn) == {key: key.encode()}
    assert learned.count("a") == 1 and learned.count("b") == 2  # used again, and forgotten
    assert memo.find(["x" * 99], learn) == {"x" * 99: b"x" * 99} and "x" * 99 not in memo.new


def test_texts_without_blanks_do_not_fill_the_memo():
    """Whole texts are one unit each; what is kept stays within the stated bytes."""
    made = small_encoder(BYTES, 1 << 20)
    words = small_encoder(BYTES, 1 << 20)
    for at in range(0, 400, 50):
        made.encode([chr(0x4E00 + (at + k) % 500) * 10_000 for k in range(50)])
        words.encode([" ".join(chr(0x4E00 + (at * k) % 2000) * 3 + str(j) for j in range(300)) for k in range(50)])
    for encoder in (made, words):
        for memo in (encoder.known, encoder.first, encoder.marks):
            kept = [memo.new, memo.old]
            assert sum(len(k) + len(v) for d in kept for k, v in d.items()) <= 2 * memo.limit
            assert all(len(k) <= pieces.LONGEST for d in kept for k in d)


def test_encode_and_decode_odd_documents(odd, nothing, reference):
    encoded = bpe.encode(odd, RANKS, public_tokenizers.PATTERN)
    rows = bpe.decode(encoded, RANKS).collect()
    plain = [(r["doc_id"], r["text"] or "") for r in odd.collect()]
    assert Counter((r["doc_id"], bytes(r["decoded"])) for r in rows) == Counter((k, t.encode()) for k, t in plain)
    assert Counter((r["doc_id"], tuple(ids_of(r["ids"]))) for r in rows) == Counter((k, tuple(reference.encode_ordinary(t))) for k, t in plain)
    assert bpe.decode(bpe.encode(nothing, RANKS, public_tokenizers.PATTERN), RANKS).collect() == []


def test_bpe_query(spark, folder, reference):
    rows = {r["doc_id"]: r for r in QUERIES["op1_byte_bpe"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(rows) == len(docs)
    for doc in docs:
        ids = reference.encode_ordinary(doc["text"] or "")
        row = rows[doc["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256((doc["text"] or "").encode()).hexdigest()


@settings(max_examples=40, deadline=None)
@given(st.sets(st.binary(max_size=12), min_size=1, max_size=300))
def test_perfect_hash_is_one_to_one(keys):
    names = sorted(keys)
    _, moves, slots = shards.PerfectHash.build(names)
    assert sorted(slots) == list(range(len(names)))
    assert len(moves) == -(-len(names) // shards.PER_BUCKET)


@settings(max_examples=25, deadline=None)
@given(st.dictionaries(st.integers(-(2**63), 2**63 - 1), st.lists(st.integers(0, 60_000), max_size=9), min_size=1, max_size=60))
def test_image_finds_its_keys_and_no_others(docs):
    keys = [shards.key_bytes(k) for k in docs]
    image = shards.Shard(shards.build_image(keys, [np.array(x, "<u2").tobytes() for x in docs.values()], 2))
    for key, ids in zip(keys, docs.values(), strict=True):
        assert image.read(*image.find(key)).tolist() == ids
    assert image.find(shards.key_bytes(12345, 9)) is None


def test_shards_of_odd_documents(spark, odd, nothing, monkeypatch):
    monkeypatch.setattr(shards, "SHARD_IDS", 1000)
    tokenizer = library(BYTES)
    path = shards.write_shards(odd, scratch_path(spark, "shards"), BYTES, 2, parts=3)
    rows = sorted(shards.read_shards(spark, path, with_ids=True).collect(), key=lambda r: r["start"])
    wanted = [(r["doc_id"], tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]) for r in odd.collect()]
    wanted.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    assert [r["key"] for r in rows] == [k for k, _ in wanted]
    assert [ids_of(r["ids"]) for r in rows] == [x for _, x in wanted]
    assert [r["start"] for r in rows] == np.cumsum([0, *(len(x) for _, x in wanted)])[:-1].tolist()
    assert [r["ids_crc32"] for r in rows] == [zlib.crc32(np.array(x, "<u4").tobytes()) for _, x in wanted]
    asked = spark.createDataFrame([(3,), (5,), (10,), (77,), (None,)], "key bigint")
    found = {r["key"]: ids_of(r["ids"]) for r in shards.fetch(spark, path, asked).collect()}
    assert found == {k: x for k, x in wanted if k in (3, 5, 10)}
    empty = shards.write_shards(nothing, scratch_path(spark, "shards"), BYTES, 2)
    assert shards.read_shards(spark, empty).collect() == []


def test_shard_query(spark, folder):
    rows = QUERIES["op5_token_shards"](spark, folder).orderBy("doc_id").collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    ids = [x.ids + [2] for x in library(BYTES).encode_batch([d["text"] or "" for d in docs], add_special_tokens=False)]
    sizes = [len(x) for x in ids]
    assert [(r["doc_id"], r["n_tokens"]) for r in rows] == [(d["doc_id"], n) for d, n in zip(docs, sizes, strict=True)]
    assert [r["start"] for r in rows] == np.cumsum([0, *sizes])[:-1].tolist()
    assert [r["ids_crc32"] for r in rows] == [zlib.crc32(np.array(x, "<u4").tobytes()) for x in ids]


def check_packed(rows, wanted: list[list[int]], size: int) -> None:
    """Every id in one piece, pieces gapless in their sequences, sequences full or powers of two."""
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["doc_id"]].append(r)
    padded = 0
    for parts in by_sequence.values():
        parts.sort()
        assert [o for o, _ in parts] == np.cumsum([0, *(n for _, n in parts)])[:-1].tolist()
        total = sum(n for _, n in parts)
        assert total <= size
        padded += size - total if total & (total - 1) else 0
    assert padded == 0
    made = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows)
    assert sum(n * c for (_, _, n, _, _), c in made.items()) == sum(len(x) for _, x in wanted)
    for key, ids in wanted:
        raw = np.array(ids, "<u4")
        for r in by_doc[key]:
            if r["doc_tokens"] == len(ids) and len({tuple(x) for k, x in wanted if k == key}) == 1:
                assert zlib.crc32(raw[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]


@pytest.mark.parametrize("merged", [2, 64])
def test_packing_of_odd_documents(odd, nothing, monkeypatch, merged):
    monkeypatch.setattr(packing, "MERGED", merged)
    tokenizer = library(WORDS)
    wanted = [(r["doc_id"], [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]) for r in odd.collect()]
    check_packed(packing.pack(odd, WORDS, 1, size=64, windows=3, with_ids=True).collect(), wanted, 64)
    assert packing.pack(nothing, WORDS, 1).collect() == []


def test_packing_query(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    ids = library(WORDS).encode_batch([d["text"] or "" for d in docs], add_special_tokens=False)
    wanted = [(d["doc_id"], [*x.ids, 1]) for d, x in zip(docs, ids, strict=True)]
    rows = QUERIES["op6_packing"](spark, folder).collect()
    check_packed(rows, wanted, 2048)
    for key, x in wanted:
        own = sorted((r["start"], r["length"]) for r in rows if r["doc_id"] == key)
        assert [s for s, _ in own] == np.cumsum([0, *(n for _, n in own)])[:-1].tolist()
        assert sum(n for _, n in own) == len(x)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60), st.integers(1, 5))
def test_packer_bounds_its_windows_and_cuts_only_to_fill(sizes, windows):
    done = []
    packer = packing.Packer(16, done.append, windows)
    for k, n in enumerate(sizes):
        packer.add(k, 0, n, b"\0" * 4 * n)
        assert len(packer.open) <= windows
    assert all(sum(len(p[3]) // 4 for p in w) == 16 for w in done)
    rest = list(packing.close_rest(packer.left(), 16))
    total = [sum(len(p[3]) // 4 for p in w) for w in rest]
    assert sum(total) + 16 * len(done) == sum(sizes)
    assert all(n == 16 or n & (n - 1) == 0 for n in total)


def test_encoding_holds_little_at_a_time():
    """Twenty million bytes of short words, as one Arrow batch: memory follows the texts encoded at a time."""
    words = " ".join(f"w{k % 997}" for k in range(25_000))
    batch = pa.RecordBatch.from_arrays([pa.array(range(160)), pa.array([words] * 160)], names=["k", "t"])
    encoder = pieces.library_encoder(public_tokenizers.path("word_bpe_49k.json"))
    usual, watched = pa.default_memory_pool(), pa.proxy_memory_pool(pa.default_memory_pool())
    pa.set_memory_pool(watched)
    try:
        made = [ids for some in by_size(iter([batch]), 1, pieces.TEXT_BYTES) for ids in encoder.encode(some.column(1).to_pylist())]
    finally:
        pa.set_memory_pool(usual)
    assert len(made) == 160 and len(set(made)) == 1
    assert watched.max_memory() < 100 << 20
    assert pieces.library_encoder(public_tokenizers.path("byte_bpe_50k.json"), narrow=True).known.limit < encoder.known.limit


def test_a_letter_that_ends_in_a_mark_joins_the_marks_behind_it():
    texts = [" İ?", "aİ? İ! x", "a\nİ? b"]
    for path in (BYTES, WORDS):
        made = pieces.library_encoder(path).encode(texts)
        assert [ids_of(x) for x in made] == [x.ids for x in library(path).encode_batch(texts, add_special_tokens=False)]


def test_a_word_is_learned_once_whatever_marks_stand_behind_it():
    """Marks come off before the memo, so that it holds words and not each word with each of its marks."""
    texts = ["it word word, word. (word) word!? word-\nword, wörd; wörd 12, x9. İ, ,, end", "", "word,  word. \n word!", ", word,\t. word."]
    for path in (BYTES, WORDS):
        small = small_encoder(path, 1 << 20)
        made = [ids_of(x) for x in small.encode(texts)]
        assert made == [x.ids for x in library(path).encode_batch(texts, add_special_tokens=False)]
        assert {"word", "wörd"} <= set(small.known.new)
        assert not {"word,", "word.", "word!?", "wörd;"} & set(small.known.new)
