"""Tokens, n-grams, TF-IDF and Word2Vec document vectors."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (
    IDF,
    HashingTF,
    NGram,
    RegexTokenizer,
    SQLTransformer,
    StopWordsRemover,
    Word2Vec,
    Word2VecModel,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.functions.text import stopword_list
from tagloom.functions.vectors import array_column, cosine
from tagloom.operators.contracts import free_name, unrolled, without_columns
from tagloom.operators.joins import estimated_bytes, join_to_one
from tagloom.operators.parts import numbers_of, parts_of, pieces, places, with_words
from tagloom.sources.storage import forget, materialise

#: Bytes of input whose terms one task counts, about.
PIECE_BYTES = 2 << 20
#: Word vectors that are summed at a time: bounds memory for very long rows.
SUMMED = 1 << 13
#: Bytes of word vectors that a task holds, at most.
VECTOR_BYTES = 160 << 20
#: Bytes that Word2Vec's trainer holds for a word besides its vectors, at least: two paths of 40
#: numbers (352), the record (40), the text (48) and the entry that finds it (56).
WORD_BYTES = 496


@dataclass(frozen=True)
class TextSpec:
    """Names and settings of the token stages. Default settings are fixed values."""

    text: str = "review_clean"
    tokens: str = "tokens"
    kept: str = "tokens_nostop"
    grams: str = "ngrams"
    terms: str = "tokens_all"
    tfidf: str = "features_tfidf"
    pattern: str = r"\w+"
    min_length: int = 2
    ngram: int = 2
    default_stopwords: bool = True
    extra_stopwords: tuple[str, ...] = ()
    keep_negations: bool = True
    keep_intensifiers: bool = False
    hash_buckets: int = 262_144
    binary_counts: bool = False
    min_doc_freq: int = 2

    @property
    def has_ngrams(self) -> bool:
        return self.ngram >= 2

    @property
    def stopwords(self) -> list[str]:
        return stopword_list(
            defaults=self.default_stopwords,
            extra=self.extra_stopwords,
            keep_negations=self.keep_negations,
            keep_intensifiers=self.keep_intensifiers,
        )


def token_stages(spec: TextSpec = TextSpec()) -> Pipeline:
    """Tokenise, drop stopwords, add n-grams, and join both into ``spec.terms``.

    Nothing in it learns from data, so fitting reads no rows; the fitted model
    can be saved and reapplied as one unit.
    """
    stages = [
        RegexTokenizer(
            inputCol=spec.text, outputCol=spec.tokens, pattern=spec.pattern,
            minTokenLength=spec.min_length, toLowercase=True, gaps=False,
        ),
        StopWordsRemover(inputCol=spec.tokens, outputCol=spec.kept, stopWords=spec.stopwords, caseSensitive=False),
    ]
    terms = spec.kept
    if spec.has_ngrams:
        stages.append(NGram(n=spec.ngram, inputCol=spec.kept, outputCol=spec.grams))
        terms = f"concat({spec.kept}, {spec.grams})"
    stages.append(SQLTransformer(statement=f"SELECT *, {terms} AS {spec.terms} FROM __THIS__"))
    return Pipeline(stages=stages)


def drop_token_columns(df: DataFrame, spec: TextSpec = TextSpec()) -> DataFrame:
    return without_columns(df, [spec.tokens, spec.kept, spec.grams, spec.terms, f"{spec.tfidf}_tf"])


def tfidf_stages(spec: TextSpec = TextSpec()) -> Pipeline:
    """Hashed term counts weighted by IDF. State is one count per hash bucket,
    whatever the vocabulary, so it scales with the corpus."""
    counts = f"{spec.tfidf}_tf"
    return Pipeline(
        stages=[
            HashingTF(inputCol=spec.terms, outputCol=counts, numFeatures=spec.hash_buckets, binary=spec.binary_counts),
            IDF(inputCol=counts, outputCol=spec.tfidf, minDocFreq=spec.min_doc_freq),
        ]
    )


def document_terms(df: DataFrame, key: str, tokens: str) -> DataFrame:
    """(key, term, tf): how often each term occurs in each row."""
    return unrolled(df, [key], tokens, "term").groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def tfidf_terms(df: DataFrame, key: str, tokens: str, *, min_doc_freq: int = 2) -> DataFrame:
    """Readable TF-IDF: (key, term, tf, df, tfidf), unhashed.

    idf = ln((N + 1) / (df + 1)), 0 below ``min_doc_freq``. ``key`` must be
    unique. The (key, term) counts are written once and read for both.
    """
    counts = materialise(document_terms(df, key, tokens), "terms")
    frequency = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    idf = F.when(F.col("df") >= min_doc_freq, F.log((total + 1) / (F.col("df") + 1))).otherwise(0.0)
    return join_to_one(counts, frequency, "term").select(key, "term", "tf", "df", (F.col("tf") * idf).alias("tfidf"))


def dealt(df: DataFrame, piece: int = PIECE_BYTES) -> DataFrame:
    """The same rows, dealt evenly over tasks of about ``piece`` bytes of input.

    A task that counts terms holds those of its own rows; this bounds them
    whatever the size of the files. Rows are dealt one by one, so copies and
    repeated keys spread like any others.
    """
    tasks = ceil(estimated_bytes(df) / piece)
    if tasks < 2:
        return df
    name = free_name(df, "deal")
    return df.withColumn(name, F.monotonically_increasing_id()).repartition(tasks, name).drop(name)


def top_terms(df: DataFrame, tokens: str, n: int = 10) -> DataFrame:
    """Most frequent terms; equal counts in alphabetical order."""
    counts = unrolled(df, [], tokens, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "term").limit(n)


def corpus_size(df: DataFrame, tokens: str, min_count: int = 1) -> tuple[int, int]:
    """(terms that occur ``min_count`` times, tokens)."""
    counts = unrolled(df, [], tokens, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    found = counts.agg(F.count_if(F.col("n") >= min_count).alias("terms"), F.sum("n").alias("tokens")).first()
    return found["terms"], found["tokens"] or 0


def frequent_terms(counts: DataFrame, share: float) -> DataFrame:
    """(term, df): the most frequent ``share`` of the terms of (key, term, tf) counts; one at least.

    Terms rank by how often they occur, equal ones in alphabetical order. They
    are sorted in ranges and numbered in place, so no task and no driver holds
    the vocabulary; the driver sees one count for each range.
    """
    terms = counts.groupBy("term").agg(F.sum("tf").alias("n"), F.count(F.lit(1)).alias("df"))
    order = [F.desc("n"), F.asc("term")]
    inside = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranges = terms.repartitionByRange(*order).sortWithinPartitions(*order)
    ranked = materialise(ranges.select("term", "df", F.spark_partition_id().alias("range"), inside.alias("place")), "terms")
    sizes = sorted(ranked.groupBy("range").count().collect())
    size = max(1, int(share * sum(r["count"] for r in sizes)))
    before = dict(zip((r["range"] for r in sizes), accumulate([0, *(r["count"] for r in sizes)]), strict=False))
    if not before:
        return ranked.select("term", "df")
    offsets = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    return ranked.filter(offsets[F.col("range")] + F.col("place") < size).select("term", "df")


def capped_tfidf_terms(df: DataFrame, key: str, tokens: str, *, share: float) -> DataFrame:
    """(key, term, tf, df, tfidf) over the most frequent ``share`` of the terms, weighed by a join.

    idf = ln((N + 1) / (df + 1)). ``key`` must be unique.
    """
    counts = materialise(document_terms(df, key, tokens), "terms")
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    idf = F.log((total + 1) / (F.col("df") + 1))
    kept = join_to_one(counts, frequent_terms(counts, share), "term")
    return kept.select(key, "term", "tf", "df", (F.col("tf") * idf).alias("tfidf"))


def _check_model(df: DataFrame, terms: int, size: int) -> None:
    """Word2Vec trains on two vectors for each word, which the driver holds with the words; say so before it runs out of memory."""
    heap = df.sparkSession.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    if terms * (2 * size * 4 + WORD_BYTES) > heap:
        raise ValueError(f"{terms:,} words with two vectors of {size} floats exceed the driver's heap of {heap:,} bytes")


@dataclass(frozen=True)
class Word2VecSpec:
    """Default settings are fixed values. ``partitions`` is the number of training
    shards; None makes one for each ``shard_tokens``, eight at least, so that it
    follows the corpus and not the cluster. More shards are faster, each then sees
    less per iteration."""

    tokens: str = "tokens_all"
    out: str = "review_embeddings"
    size: int = 300
    window: int = 3
    min_count: int = 5
    iterations: int = 15
    seed: int = 42
    partitions: int | None = None
    shard_tokens: int = 20_000_000

    def shards(self, tokens: int) -> int:
        return self.partitions or max(8, ceil(tokens / self.shard_tokens))


def fit_word2vec(df: DataFrame, spec: Word2VecSpec = Word2VecSpec(), *, key: str | None = "review_key") -> Word2VecModel:
    """Train word vectors on the rows that have tokens.

    Rows are placed and ordered by the unique ``key``, so a seed gives the same
    shards on any cluster; without a key they are dealt out evenly. One partition
    trains reproducibly; several train in parallel and are averaged, and tasks
    sharing an executor see each other's updates, so vectors then vary a little
    between runs. The vocabulary is counted first: vectors are held by the
    driver and shipped to every executor, so more than its heap can hold are
    refused before training instead of failing in the middle; beyond that use
    ``word_vectors.corpus_vectors``. ``df`` is read several times; pass a written
    table.
    """
    usable = df.filter(F.size(F.col(spec.tokens)) > 0).select(*([key] if key else []), spec.tokens)
    terms, tokens = corpus_size(usable, spec.tokens, spec.min_count)
    _check_model(df, terms, spec.size)
    parts = spec.shards(tokens)
    shards = usable.repartition(parts, key).sortWithinPartitions(key) if key else usable.repartition(parts)
    trainer = Word2Vec(
        inputCol=spec.tokens, outputCol=spec.out, vectorSize=spec.size, windowSize=spec.window,
        minCount=spec.min_count, maxIter=spec.iterations, seed=spec.seed, numPartitions=parts,
    )
    return trainer.fit(shards)


def embed(df: DataFrame, model: Word2VecModel | VectorTable, out: str = "review_embeddings") -> DataFrame:
    """Mean of the word vectors of each row, replacing a column of that name."""
    if model.getOutputCol() != out:
        raise ValueError(f"Model writes {model.getOutputCol()!r}, expected {out!r}")
    return model.transform(df.drop(out) if out in df.columns else df)


def embed_by_join(
    df: DataFrame, vectors: DataFrame, *, key: str, tokens: str, out: str = "review_embeddings", size: int
) -> DataFrame:
    """``embed`` for word vectors kept as a (word, vector) table of any size.

    Rows are dealt over tasks as numbers of their words; each task gets the
    vectors once and sums them in place, so one sum for each row moves on and
    not one vector for each word of each row. There are so many tasks that the copies of
    the vectors stay small beside the rows; vectors of more than ``VECTOR_BYTES`` are
    dealt over sets, of which a task has one. Words without a
    vector count in the mean as zeros, rows without known words give zeros. The
    sums are written; ``forget`` the result to delete them.
    """
    table = vectors.select("word", F.col("vector").cast("array<double>").alias("vector"))
    numbered = materialise(table.withColumn("number", F.monotonically_increasing_id()), "numbered")
    bytes_ = max(1, numbered.count() * size * 8)
    sets = ceil(bytes_ / VECTOR_BYTES)
    table = numbered.withColumn("set", F.pmod("number", F.lit(sets)).cast("int"))
    met = with_words(
        df.filter(F.col(key).isNotNull()), tokens, table.select("word", "number", "set"), [key], each=table.select("number", "vector", "set"),
        sets=sets, tasks=lambda tokens, parts: max(2, 2 * tokens // bytes_),
    )
    kind = met.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, numbers, matrix = None, np.empty(0, np.int64), np.empty((0, size))
        for table, rows in parts_of(batches):
            if rows is None:
                numbers, matrix = table.column("number").to_numpy(), _rows_of(table.column("vector"), size)
                order = np.argsort(numbers, kind="stable")
                numbers, matrix = numbers[order], matrix[order]
                continue
            if table is None:
                continue
            if table is not last:
                last, own_rows = table, numbers_of(table, "number")
                own_rows = np.where(own_rows >= 0, np.searchsorted(numbers, own_rows), -1)
            for piece in pieces(rows):
                owner, place = places(piece, own_rows)
                owner, place = owner[place >= 0], place[place >= 0]
                named = piece.column(key).dictionary_encode()
                owner = named.indices.to_numpy()[owner]
                if np.any(owner[1:] < owner[:-1]):
                    order = np.argsort(owner, kind="stable")
                    owner, place = owner[order], place[order]
                sums = np.zeros((len(named.dictionary), size))
                for start in range(0, len(owner), SUMMED):
                    own = owner[start : start + SUMMED]
                    first = np.flatnonzero(np.diff(own, prepend=-1))
                    sums[own[first]] += np.add.reduceat(matrix[place[start : start + SUMMED]], first)
                found = np.unique(owner)
                ends = pa.array(np.arange(len(found) + 1, dtype=np.int32) * size)
                totals = pa.ListArray.from_arrays(ends, pa.array(sums[found].ravel()))
                yield pa.RecordBatch.from_arrays([named.dictionary.take(pa.array(found)), totals], names=["key", "total"])

    partial = met.mapInArrow(run, f"key {kind}, total array<double>")
    lists = partial.groupBy(F.col("key").alias(key)).agg(F.collect_list("total").alias("totals"))
    more = F.slice("totals", F.lit(2), F.size("totals"))
    added = F.reduce(more, F.get("totals", F.lit(0)), lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
    sums = materialise(lists.select(key, added.alias("total")), "sums")
    forget(met, numbered)
    length = free_name(df, "length")
    totals = F.coalesce(F.col("total"), F.array_repeat(F.lit(0.0), size))
    mean = F.transform(totals, lambda x: F.coalesce(F.try_divide(x, F.col(length)), F.lit(0.0)))
    made = df.withColumn(length, F.size(F.col(tokens))).join(sums, key, "left").withColumn(out, mean).drop("total", length)
    made.__dict__["scratch"] = sums.__dict__["scratch"]
    return made


def _rows_of(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return column.combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


@dataclass(frozen=True)
class VectorTable:
    """Word vectors kept as a (word, vector) table, in the place of a Word2Vec model.

    ``key`` must be unique in the rows that are transformed. ``written`` are results whose
    sums can be forgotten once they are stored.
    """

    vectors: DataFrame
    tokens: str
    out: str
    size: int
    key: str = "review_key"
    written: list[DataFrame] = field(default_factory=list, compare=False, repr=False)

    def getOutputCol(self) -> str:
        return self.out

    def transform(self, df: DataFrame) -> DataFrame:
        embedded = embed_by_join(df, self.vectors, key=self.key, tokens=self.tokens, out=self.out, size=self.size)
        self.written.append(embedded)
        return embedded.withColumn(self.out, array_to_vector(self.out))


def nearest_words(vectors: DataFrame, word: str, n: int = 5) -> DataFrame:
    """(word, similarity) of the ``n`` words closest to one by cosine, from a (word, vector) table.

    The word's own vector travels with the plan and the table is scored where it
    lies; equal similarities in alphabetical order. An unknown word has none.
    """
    rows = vectors.select("word", array_column(vectors, "vector").alias("vector"))
    own = rows.filter(F.col("word") == word).first()
    target = F.lit([float(x) for x in own["vector"]] if own else None).cast("array<double>")
    scored = rows.filter(F.col("word") != word)
    scored = scored.select("word", F.round(cosine(F.col("vector"), target), 9).alias("similarity"))
    return scored.filter(F.col("similarity").isNotNull()).orderBy(F.desc("similarity"), "word").limit(n)


def apply_features(
    df: DataFrame, prep: PipelineModel, model: Word2VecModel | VectorTable, out: str = "features"
) -> DataFrame:
    """Saved token stages, then document vectors as ``out``."""
    embedded = embed(prep.transform(df), model, model.getOutputCol())
    return embedded.withColumn(out, F.col(model.getOutputCol()))
