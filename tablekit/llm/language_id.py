"""Language identification by n-gram filters that answer for all languages at once."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekit.llm.common import discard, free_name, mix64, odd_powers, staged

MOST_TRAINING_ROWS = 4_000  # per language
GRAM = 4
HASHES, FALSE_RATE = 3, 0.005  # of a language's filter, for the one with the most n-grams
LEAST_SHARE = 0.3
SMOOTHING = 10_000  # n-grams that every language counts as having besides, none of them known
UNKNOWN = "und"
# Words are letters with the marks that belong to them. In texts of Latin letters up to
# U+024F, which have no marks of their own, a plain class finds the same.
_LATIN = re.compile("[a-z\u00aa\u00b5\u00ba\u00df-\u00f6\u00f8-\u024f]+")
_BEYOND_LATIN = re.compile("[^\x00-\u024f]")
_WORDS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_BLOCK_CHARS = 1 << 18


@dataclass
class Filters:
    """A Bloom filter per language, sliced by bit: ``slices[s, i]`` has at slot i one bit
    for each of 8 languages (64 in all slices of a table of 8). ``false`` is each
    language's rate of false hits."""

    languages: list[str]
    slices: np.ndarray
    false: np.ndarray


def _letters(text: str | None) -> str:
    """The words in lower case, with one space between them and around it all."""
    lower = (text or "").lower()
    words = (_WORDS if _BEYOND_LATIN.search(lower) else _LATIN).findall(lower)
    return f" {' '.join(words)} "


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of letters and word ends, and the number of the text of each."""
    data = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.uint64)
    sizes = np.array([len(t) for t in texts], np.int64)
    if len(data) < GRAM:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    weights = odd_powers(0x9E3779B97F4A7C15, GRAM + 1)[1:]
    count = len(data) - GRAM + 1
    total = np.zeros(count, np.uint64)
    for i in range(GRAM):
        total += (data[i : i + count] + np.uint64(1)) * weights[i]
    owner = np.repeat(np.arange(len(texts)), sizes)
    whole = np.repeat(np.cumsum(sizes), sizes)[:count] - np.arange(count) >= GRAM
    return mix64(total[whole]), owner[:count][whole]


def _places(hashes: np.ndarray, slots: int) -> list[np.ndarray]:
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    return [((hashes + np.uint64(i) * step) % np.uint64(slots)).astype(np.int64) for i in range(HASHES)]


def build(languages: list[str], grams_of: list[np.ndarray]) -> Filters:
    """Filters of each language's n-grams, as large as the largest needs for FALSE_RATE."""
    most = max(map(len, grams_of), default=0)
    slots = max(64, ceil(most * HASHES / -log(1 - FALSE_RATE ** (1 / HASHES))))
    slices = np.zeros(((len(languages) + 7) // 8, slots), np.uint8)
    for k, hashes in enumerate(grams_of):
        for place in _places(hashes, slots):
            slices[k // 8, place] |= np.uint8(1 << k % 8)
    full = np.array([np.count_nonzero(slices[k // 8] & np.uint8(1 << k % 8)) / slots for k in range(len(languages))])
    return Filters(languages, slices, full**HASHES)


def train(df: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id", most: int = MOST_TRAINING_ROWS) -> Filters:
    """Filters from rows with a language that is not null, whole texts.

    Of each language about ``most`` rows with the smallest hash of ``key`` are taken
    (all, if there are fewer): a bound that does not depend on the size of the corpus. An
    n-gram goes into a language's filter if its rate there is at least 0.3 of the sum of
    its rates in all languages, so rows with a wrong language do no harm. A rate is a
    count over the language's n-grams and 10,000 more, so that one n-gram in the few rows
    of a language does not outweigh thousands elsewhere; the same rule holds whatever the
    number of rows. An n-gram enters three filters at most; counts stay in Spark, and only
    what enters a filter reaches the driver, 12 bytes for each.
    """
    spark = df.sparkSession
    known = df.where(F.col(f"`{lang}`").isNotNull()).select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").cast("string").alias("text"), F.xxhash64(F.col(f"`{key}`")).alias("key"))
    there = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(there)
    if not languages:
        return build([], [])
    shares = spark.createDataFrame([(k, int(min(1, most / n) * 2**31)) for k, n in there.items()], "lang string, share bigint")
    number = {k: i for i, k in enumerate(languages)}
    rows = known.join(F.broadcast(shares), "lang").where(F.pmod("key", F.lit(2**31)) < F.col("share")).select("text", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of = np.array([number[x.as_py()] for x in batch.column(1)], np.int64)
            with np.errstate(over="ignore"):
                found, owner = grams([_letters(t.as_py()) for t in batch.column(0)])
            order = np.lexsort((found, of[owner]))
            g, k = found[order], of[owner][order]
            heads = np.flatnonzero(np.append(True, (g[1:] != g[:-1]) | (k[1:] != k[:-1]))) if len(g) else np.empty(0, np.int64)
            counts = np.diff(np.append(heads, len(g)))
            yield pa.RecordBatch.from_arrays([pa.array(g[heads].view(np.int64)), pa.array(k[heads].astype(np.int32)), pa.array(counts)], names=["gram", "k", "n"])

    counts = staged(rows.mapInArrow(run, "gram bigint, k int, n bigint").groupBy("gram", "k").agg(F.sum("n").alias("n")), "grams")
    sizes = {r["k"]: r["n"] for r in counts.groupBy("k").agg(F.sum("n").alias("n")).collect()}
    size = F.element_at(F.array(*[F.lit(float(sizes.get(k, 0) + SMOOTHING)) for k in range(len(languages))]), F.col("k") + 1)
    rates = counts.select("gram", "k", (F.col("n") / size).alias("rate"))
    among = rates.groupBy("gram").agg(F.sum("rate").alias("total"), F.collect_list(F.struct("k", "rate")).alias("of"))
    entering = among.select("gram", "total", F.explode("of").alias("one")).where(F.col("one.rate") >= LEAST_SHARE * F.col("total"))
    table = entering.select("gram", "one.k").toArrow()
    discard(counts)
    gram, k = np.asarray(table.column("gram")).view(np.uint64), np.asarray(table.column("k"))
    with np.errstate(over="ignore"):
        return build(languages, [gram[k == i] for i in range(len(languages))])


def _blocks(texts: list[str]) -> Iterator[tuple[np.ndarray, list[str]]]:
    """The texts in blocks of some 262,144 characters, long ones cut into pieces that
    overlap by less than an n-gram, so that each n-gram is in one piece. Yields the
    numbers of the pieces' texts, and the pieces."""
    owners, pieces, chars = [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - GRAM + 1), _BLOCK_CHARS):
            piece = text[at : at + _BLOCK_CHARS + GRAM - 1]
            if pieces and chars + len(piece) > _BLOCK_CHARS:
                yield np.array(owners), pieces
                owners, pieces, chars = [], [], 0
            owners.append(i)
            pieces.append(piece)
            chars += len(piece)
    if pieces:
        yield np.array(owners), pieces


def decide(filters: Filters, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Language and score of each text. An n-gram's filters are read once per hash, for
    all languages together; the hits of a language, less those its false rate explains,
    are compared as shares of the text's n-grams. The score is the winner's part of the
    sum of these shares, times its share; ties go to the first language by name."""
    clean = [_letters(t) for t in texts]
    n_lang = len(filters.languages)
    hits, totals = np.zeros((len(texts), max(n_lang, 1))), np.zeros(len(texts))
    for owners, pieces in _blocks(clean):
        with np.errstate(over="ignore"):
            found, piece = grams(pieces)
            places = _places(found, filters.slices.shape[1])
        owner = owners[piece]
        totals += np.bincount(owner, minlength=len(texts))
        for s in range(len(filters.slices)):
            mask = filters.slices[s, places[0]]
            for place in places[1:]:
                mask = mask & filters.slices[s, place]
            for k in range(8 * s, min(8 * s + 8, n_lang)):
                hits[:, k] += np.bincount(owner, (mask >> np.uint8(k % 8)) & np.uint8(1), minlength=len(texts))
    langs, scores = [], []
    for i, text in enumerate(clean):
        if not n_lang or not text.strip():
            langs.append(UNKNOWN)
            scores.append(0.0)
            continue
        share = np.maximum(0, (hits[i] / max(totals[i], 1) - filters.false) / np.maximum(1 - filters.false, 1e-9))
        best = int(np.argmax(share))
        langs.append(filters.languages[best])
        scores.append(float(min(1.0, share[best] * share[best] / share.sum())) if share[best] > 0 else 0.0)
    return langs, scores


def predict(df: DataFrame, filters: Filters, text: str = "text") -> DataFrame:
    """All columns of ``df`` with lang_pred and score (0 to 1) of each whole text. Null
    texts and texts without a letter (numbers of any kind and lone marks are none) are
    ``und`` with score 0, as are all if no language was learnt; a text without any known n-gram gets the first language, score 0. Names
    already taken get underscores after them."""
    names = [free_name(df.columns, "lang_pred"), free_name(df.columns, "score")]
    place = df.columns.index(text)
    schema = T.StructType([*df.schema.fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    shared = df.sparkSession.sparkContext.broadcast((filters.languages, filters.slices, filters.false))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Filters(*shared.value)
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                batch = whole.slice(at, 1000)
                langs, scores = decide(known, [t.as_py() for t in batch.column(place)])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*batch.schema.names, *names])

    return df.mapInArrow(run, schema)
