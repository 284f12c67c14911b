import pytest
from brute import copies
from conftest import SF_DIR

from tablekit.llm import content_sort
from tablekit.llm.content_sort import exact_duplicates
from tablekit.llm.queries import op13_exact_dedup

COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def check(df, rows, n):
    assert df.columns == COLUMNS
    got, expected = df.collect(), copies(rows)
    assert len(got) == n
    for r in got:
        assert (r["keep_id"], r["group_size"], r["text_sha256"]) == expected[r["doc_id"]]
    for text in {r["text_sha256"] for r in got}:
        assert [r["doc_id"] for r in got if r["kept"] and r["text_sha256"] == text] == [expected[next(r["doc_id"] for r in got if r["text_sha256"] == text)][0]]


def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    check(op13_exact_dedup(spark, SF_DIR), rows, len(rows))


@pytest.mark.parametrize("sample", [100_000, 400])
def test_hot_texts_in_slices(spark, monkeypatch, sample):
    monkeypatch.setattr(content_sort, "LEAST_SAMPLE", sample)
    rows = [(i, "hot  text" if i % 3 else f"text\t{i // 2}" if i % 2 else "hot\ntext ") for i in range(2000, 0, -1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    check(exact_duplicates(df), rows, 2000)


def test_texts_that_begin_alike(spark):
    rows = [(i, "the same beginning of every text, " * 3 + str(i // 3)) for i in range(300)]
    check(exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")), rows, 300)


def test_no_hot_text(spark):
    rows = [(i, f"text {i // 2}") for i in range(100)]
    check(exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")), rows, 100)


def test_odd_rows(spark, odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    check(exact_duplicates(odd), rows, len(rows))
    nulls = [(None, "a"), (None, "a"), (None, "b"), (3, "b"), (3, "b"), (None, None), (None, "")]
    got = sorted(tuple(str(x) for x in r[:4]) for r in exact_duplicates(spark.createDataFrame(nulls, "doc_id bigint, text string")).collect())
    assert got == [("3", "3", "3", "False"), ("3", "3", "3", "True"), ("None", "3", "3", "False")] + [("None", "None", "2", k) for k in ("False", "False", "True", "True")]
    assert exact_duplicates(empty).count() == 0
    assert exact_duplicates(empty).columns == COLUMNS


def test_extra_columns_may_have_the_names_of_results(spark):
    df = spark.createDataFrame([(1, "a", 7, "n"), (2, "a", 8, "m")], "doc_id int, text string, KEEP_ID int, norm string")
    out = exact_duplicates(df, keep=["doc_id", "KEEP_ID", "norm"])
    assert out.columns == ["doc_id", "KEEP_ID", "norm", "keep_id_", "group_size", "kept", "text_sha256"]
    assert sorted((r["KEEP_ID"], r["keep_id_"], r["kept"]) for r in out.collect()) == [(7, 1, True), (8, 1, False)]


@pytest.mark.parametrize("copies", [1, 500])
def test_texts_move_once_by_range_and_no_python_runs(spark, monkeypatch, copies):
    plans = []

    def planned(df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, label)

    real = content_sort.staged
    monkeypatch.setattr(content_sort, "staged", planned)
    rows = [(i, f"text {i // copies}") for i in range(1000)]
    out = exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"))
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    moves = next(p for p in plans if "rangepartitioning(start" in p)
    assert "hashpartitioning" not in moves and moves.count("rangepartitioning") == 1
    assert len(plans) == (4 if copies > 1 else 2)
    assert not any(word in p for p in plans for word in ("Python", "Arrow", "Pandas"))
