"""Spelling variants: words one edit apart, found in a bit-sliced position index."""

from __future__ import annotations

from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablekit.llm.common import discard, staged

# Letters of a word. Only A-Z have a lower case here.
LETTERS = "A-Za-zÀ-ÿ"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MOST_PIECES = 8
SHARD_ENTRIES = 8192
LONG = 64  # words from this length on are counted together when shards are sized
_QUERIES = 1024  # words that pass through an index at the same time
_MOST_HITS = 1 << 23  # and that number times the words of the index, at most


def word_counts(df: DataFrame, least_length: int, least_count: int, typo_every: int | None = None, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): runs of letters of the whole texts, A-Z in lower case, with at least
    ``least_length`` code points and ``least_count`` occurrences.

    With ``typo_every`` a run of a document loses one letter where that number divides
    the crc32 of ``<id>:<run>``: planted errors, to measure what is found. Null texts
    have no words; a null id counts as empty there. Repeated rows count again.
    """
    found = F.regexp_extract_all(F.col(f"`{text}`").cast("string"), F.lit(f"([{LETTERS}]+)"), F.lit(1))
    runs = df.select(F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")).alias("id"), F.explode(found).alias("run"))
    # lower() is right, and quick, where all letters are ASCII
    ascii_only = F.octet_length("run") == F.length("run")
    runs = runs.select("id", F.when(ascii_only, F.lower("run")).otherwise(F.translate("run", _UPPER, _LOWER)).alias("run"))
    word: Column = F.col("run")
    if typo_every:
        hash = F.crc32(F.concat_ws(":", "id", "run").cast("binary"))
        at = F.pmod(hash, F.length("run")).cast("int")
        cut = F.concat(F.expr("left(run, at)"), F.expr("substring(run, at + 2)"))
        runs = runs.select("run", hash.alias("hash"), at.alias("at"))
        word = F.when(F.pmod("hash", F.lit(typo_every)) == 0, cut).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _entries(words: DataFrame) -> DataFrame:
    """(length, shard, key, word, n): where each word meets those one edit away.

    Of two words of length L, or L and L + 1, the shorter is cut into pieces of two
    letters (eight pieces at most). One edit touches one piece, so for some piece both
    words agree before and after it: that is the key. A word takes part for L = its own
    length and one less. A bucket's words differ in one short piece only, so its size is
    bounded by the letters there are, not by the corpus.
    """
    histogram = {r["m"]: r["n"] for r in words.groupBy(F.least(F.length("word"), F.lit(LONG)).alias("m")).agg(F.count("*").alias("n")).collect()}
    pieces_of = lambda size: max(1, min(MOST_PIECES, (size + 1) // 2))
    shards = [max(1, ceil(pieces_of(m) * (histogram.get(m, 0) + histogram.get(min(m + 1, LONG), 0)) / SHARD_ENTRIES)) for m in range(LONG + 1)]
    roles = words.select("word", "n", F.length("word").alias("size"), F.explode(F.array(F.length("word"), F.length("word") - 1)).alias("length"))
    pieces = F.greatest(F.lit(1), F.least(F.lit(MOST_PIECES), F.expr("(length + 1) div 2").cast("int")))
    cut = roles.where("length > 0").withColumn("pieces", pieces).select("*", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
    before = F.expr("left(word, cast(piece * length div pieces as int))")
    after = F.expr("substring(word, cast((piece + 1) * length div pieces + (size - length) + 1 as int))")
    key = F.xxhash64("length", "piece", before, F.lit("|"), after)
    count = F.element_at(F.array(*[F.lit(s) for s in shards]), F.least("length", F.lit(LONG)) + 1)
    return cut.select("length", key.alias("key"), "word", "n").withColumn("shard", F.pmod("key", count).cast("int"))


def near_in_shard(words: list[str], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a, b) of places in ``words``, of which a has ``length`` letters and b as
    many or one more, that are exactly one replaced or one inserted letter apart.

    Bit w of the set for (position, letter) says that word w has the letter there. All
    words of the length walk through the positions together. ``zero`` is the set of words
    that agree with the prefix read so far; ``replaced`` those that differ in one place;
    ``longer`` those that have one letter more so far, so they are read one position
    further on. One pass over the positions keeps all three at once.
    """
    n = len(words)
    sizes = np.array([len(w) for w in words])
    codes = np.zeros((n, length + 2), np.uint32)
    letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    place = np.arange(len(letters)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    known, numbers = np.unique(letters, return_inverse=True)
    codes[np.repeat(np.arange(n), sizes), place] = numbers + 1
    width = (n + 63) // 64

    def bits(mask: np.ndarray) -> np.ndarray:
        padded = np.zeros((len(mask), width * 64), bool)
        padded[:, :n] = mask
        return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)

    def sets_at(position: int) -> np.ndarray:
        has = np.zeros((len(known) + 1, width * 64), bool)
        has[codes[:, position], np.arange(n)] = True
        has[0] = False  # beyond the end of a word there is no letter
        return np.packbits(has, axis=1, bitorder="little").view(np.uint64)

    as_long, one_more = bits((sizes == length)[None, :]), bits((sizes == length + 1)[None, :])
    left, right = [], []
    asking = np.flatnonzero(sizes == length)
    together = max(1, min(_QUERIES, _MOST_HITS // max(1, n)))
    for begin in range(0, len(asking), together):
        queries = asking[begin : begin + together]
        zero = np.repeat(as_long | one_more, len(queries), axis=0)
        replaced, longer = np.zeros_like(zero), np.zeros_like(zero)
        here = sets_at(0)
        for i in range(length):
            further = sets_at(i + 1)
            letter = codes[queries, i]
            same = here[letter]
            longer = (longer | zero) & further[letter]
            replaced = (replaced & same) | (zero & ~same)
            zero &= same
            here = further
        hits = (replaced & as_long) | ((longer | zero) & one_more)
        a, b = np.nonzero(np.unpackbits(hits.view(np.uint8), axis=1, count=n, bitorder="little"))
        left.append(queries[a])
        right.append(b)
    none = np.empty(0, np.int64)
    return (np.concatenate(left), np.concatenate(right)) if left else (none, none)


def _near_words(table: pa.Table) -> pa.Table:
    """Both directions of the pairs in one shard; words alone in all their buckets are
    left out first."""
    keys = np.asarray(table.column("key"))
    _, at, counts = np.unique(keys, return_inverse=True, return_counts=True)
    table = table.filter(pa.array(counts[at] > 1))
    counted = dict(zip(table.column("word").to_pylist(), table.column("n").to_pylist()))
    words = sorted(counted)
    a, b = near_in_shard(words, int(table.column("length")[0].as_py())) if words else ([], [])
    pairs = [(words[i], words[j]) for i, j in zip(a, b)]
    pairs += [(y, x) for x, y in pairs if len(x) != len(y)]
    return pa.table(
        {
            "word": pa.array([x for x, _ in pairs], pa.string()),
            "near": pa.array([y for _, y in pairs], pa.string()),
            "near_n": pa.array([counted[y] for _, y in pairs], pa.int64()),
        }
    )


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for each word with a form, by pointers that double their reach each
    round. Counts at least double from form to form, so chains are short and have no
    cycle."""
    links = staged(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        moved = staged(links.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved")), "forms")
        discard(links)
        links = moved
        if links.where("moved").isEmpty():
            return links


def spelling_variants(counts: DataFrame, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for each row (word, n) of ``counts``.

    Two words are near if they differ by exactly one inserted, deleted or replaced code
    point. ``form`` is the near word with the largest n (ties: the smallest in code-point
    order) if its n is at least ``ratio`` times the word's, else null, as is ``form_n``;
    ``root`` is where forms lead in the end, the word itself without a form; ``n_near``
    counts the near words. ``ratio`` must be at least 2, so that forms lead upwards.
    Words are distinct and not null; an empty table gives an empty result.
    """
    if ratio < 2:
        raise ValueError("ratio must be at least 2")
    words = staged(counts.select("word", "n"), "words")
    shards = _entries(words).groupBy("length", "shard")
    near = shards.applyInArrow(_near_words, "word string, near string, near_n bigint").distinct()
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best"))
    is_form = -F.col("best.less") >= F.lit(ratio) * F.col("n")
    found = words.join(best, "word", "left").select(
        "word", F.when(is_form, F.col("best.form")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(is_form, -F.col("best.less")).alias("form_n")
    )
    found = staged(found, "near_words")
    roots = _roots(found.where(F.col("form").isNotNull()))
    discard(words)
    joined = found.join(roots.select("word", "root"), "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
