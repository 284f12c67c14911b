import random

import pytest
from brute import spelling, with_forms
from conftest import SF_DIR

from tablekit.llm import position_index
from tablekit.llm.position_index import near_in_shard, spelling_variants, word_counts
from tablekit.llm.queries import op11_spelling_variants

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def result(df):
    assert df.columns == COLUMNS
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: tuple(r)[1:] for r in rows}


def frame(spark, counts):
    return spark.createDataFrame([*counts.items()], "word string, n bigint")


def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    expected = spelling(rows)
    assert sum(form is not None for form, *_ in expected.values()) > 20
    assert result(op11_spelling_variants(spark, SF_DIR)) == expected


@pytest.mark.parametrize("entries", [8192, 16])
def test_every_pair_one_edit_apart_whatever_the_shards(spark, monkeypatch, entries):
    monkeypatch.setattr(position_index, "SHARD_ENTRIES", entries)
    monkeypatch.setattr(position_index, "_QUERIES", 7)
    rng = random.Random(5)
    counts = {}
    for size in (1, 2, 5, 6, 9, 40, 90):
        base = "".join(rng.choices("abé", k=size))
        for _ in range(60):
            word = list(base)
            for _ in range(rng.choice([1, 1, 2])):
                at = rng.randrange(len(word) + 1)
                word[at : at + rng.choice([0, 1])] = rng.choices("abÿ", k=rng.choice([0, 1]))
            if word:
                counts["".join(word)] = rng.randrange(1, 40)
    assert result(spelling_variants(frame(spark, counts))) == with_forms(counts)


def test_a_shard_keeps_zero_and_one_error_apart():
    words = ["abcde", "abxde", "abcdef", "xabcde", "abcd", "abced", "bcdea"]
    pairs = {(words[i], words[j]) for i, j in zip(*near_in_shard([w for w in words if len(w) > 4], 5))}
    kept = [w for w in words if len(w) > 4]
    pairs = {(kept[i], kept[j]) for i, j in zip(*near_in_shard(kept, 5))}
    assert pairs == {("abcde", "abxde"), ("abxde", "abcde"), ("abcde", "abcdef"), ("abcde", "xabcde")}


def test_chains_ties_and_counts(spark):
    counts = {"aaaaaaaa": 3, "aaaaaaab": 6, "aaaaaabb": 12, "aaaaabbb": 24, "aaaabbbb": 48, "aaabbbbb": 95, "zaaaa": 2, "zaaab": 4, "zaaac": 4}
    got = result(spelling_variants(frame(spark, counts)))
    assert got == with_forms(counts)
    assert got["aaaaaaaa"][:2] == ("aaaaaaab", "aaaabbbb") and got["aaaabbbb"][0] is None
    assert got["zaaaa"][0] == "zaaab"
    with pytest.raises(ValueError, match="ratio"):
        spelling_variants(frame(spark, counts), ratio=1)


def test_odd_rows(spark, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    for least_length, least_count in ((1, 1), (4, 3), (5, 3)):
        got = result(spelling_variants(word_counts(odd, least_length, least_count, typo_every=97)))
        assert got == spelling(rows, least_length, least_count)
    assert result(spelling_variants(word_counts(empty, 5, 3))) == {}
    assert spelling_variants(frame(spark, {"alone": 4})).collect()[0]["root"] == "alone"


def test_letters_and_planted_errors(spark):
    text = "Straße STRASSE Àpropos àpropos ÀPROPOS naïve×2 l'été x1y2 " * 3
    rows = [(i, text) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["word"]: r["n"] for r in word_counts(df, 1, 1, typo_every=97).collect()}
    assert got == {w: v[2] for w, v in spelling(rows, 1, 1).items()}
    assert "àpropos" in got and "Àpropos" in got and "straße" in got


def test_a_very_long_word(spark):
    word = "ab" * 20_000
    counts = {word: 9, word[:-1] + "c": 3, word + "d": 4, word[1:]: 2}
    got = result(spelling_variants(frame(spark, counts)))
    assert [got[w][2:4] for w in counts] == [(9, 3), (3, 1), (4, 1), (2, 1)]
    assert all(got[w][1] == word for w in counts)
