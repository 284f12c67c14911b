import numpy as np
import pytest
from brute import near_documents, without_repeats
from conftest import SF_DIR

from tablekit.llm import embedding_dedup, minhash, suffix_dedup
from tablekit.llm.components import connected_components
from tablekit.llm.queries import op1_minhash_dedup, op2_embedding_dedup, op8_suffix_array_dedup
from tablekit.llm.suffix_array import common_prefixes, suffix_array


def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_minhash_query_against_brute_force(spark):
    expected = near_documents(texts_of(documents(spark)), 4)
    rows = op1_minhash_dedup(spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def edited(base, share, rng):
    words = list(base)
    for k in np.flatnonzero(rng.random(len(words)) < share):
        words[k] = f"new{rng.integers(1 << 30)}"
    return " ".join(words)


def test_a_large_group_of_near_copies_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 7)
    rng = np.random.default_rng(3)
    base = [f"w{k}" for k in range(120)]
    rows = [(1000 - i, edited(base, rng.random() * 0.12, rng)) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df, words_each=4).collect()}
    expected = near_documents(rows, 4)
    assert len({c for _, c in expected.values()}) > 3
    assert got == expected


@pytest.fixture
def small_skew_thresholds(spark):
    wanted = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8",
        "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_a_text_copied_very_often_is_split_over_tasks(spark, small_skew_thresholds):
    rows = [(i, "one text that half of all rows hold and more words" if i % 2 else f"{i} is a text of its own number {i * 7} and {i * 3}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(8)
    out = minhash.near_duplicates(df, words_each=4)
    assert "skew=true" in final_plan(out)
    got = {r["doc_id"]: r["component_id"] for r in out.collect()}
    assert all(got[i] == (1 if i % 2 else i) for i in range(20_000))


def test_minhash_odd_rows(odd, empty):
    out = minhash.near_duplicates(odd, words_each=4)
    assert out.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    rows = out.collect()
    assert len(rows) == odd.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[7]["component_id"] == 6 and not by_id[7]["kept"]
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]
    assert all(by_id[i]["n_shingles"] == 0 and by_id[i]["kept"] for i in range(4))
    assert minhash.near_duplicates(empty).count() == 0


def test_sketches_fill_every_coordinate_and_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(0)
    pool = rng.integers(1, 2**63, 3000).astype(np.uint64)
    with np.errstate(over="ignore"):
        one, two = minhash.sketches([pool[:2000], pool[500:2500]], 512)
        small = minhash.sketches([pool[:1], pool[:1], pool[:3]], 96)
    assert abs((one == two).mean() - 1500 / 2500) < 0.08
    assert (small[0] == small[1]).all() and len(set(small[0].tolist())) > 1


def test_components_of_a_path_and_a_star(spark):
    path = [(k, k + 1) for k in range(40)]
    star = [(100, k) for k in range(50, 100)]
    rows = {r["id"]: r["component"] for r in connected_components(spark.createDataFrame(path + star, "a bigint, b bigint")).collect()}
    assert rows == {**{k: 0 for k in range(41)}, **{k: 50 for k in range(50, 101)}}
    assert connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


@pytest.mark.parametrize("letters", [1, 2, 4, 200])
def test_suffix_array_and_common_prefixes(letters):
    s = np.random.default_rng(letters).integers(1, letters + 1, 1500).astype(np.uint16)
    s[900:1300] = s[100:500]
    raw = bytes(s.astype(np.uint8))
    order = suffix_array(s)
    assert order.tolist() == sorted(range(len(s)), key=lambda i: raw[i:])
    shared = common_prefixes(s, order, 100)
    for k in range(1, len(s)):
        a, b = raw[order[k - 1] :], raw[order[k] :]
        same = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert shared[k] == min(same, 100)


@pytest.mark.parametrize("regions", [2000, 3])
def test_suffix_query_against_brute_force(spark, monkeypatch, regions):
    monkeypatch.setattr(suffix_dedup, "SHARD_REGIONS", regions)
    df = documents(spark) if regions > 3 else documents(spark).where("doc_id < 60")
    rows = (op8_suffix_array_dedup(spark, SF_DIR) if regions > 3 else suffix_dedup.remove_repeats(df)).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows}
    assert got == without_repeats(texts_of(df))
    assert any(r["n_removed"] for r in rows)


def test_suffix_planted_passages(spark):
    rng = np.random.default_rng(5)
    word = lambda: "".join(rng.choice(list("abcdefghé"), 6))
    passage = " ".join(word() for _ in range(40))
    rows = [(i, " ".join([*(word() for _ in range(30)), passage[i % 7 :], *(word() for _ in range(20))])) for i in range(30)]
    rows += [(40, passage * 3), (41, "z" * 1000), (42, "z" * 99), (43, None), (44, ""), (45, passage[:100])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == without_repeats(rows)


def test_suffix_odd_rows(odd, empty):
    out = suffix_dedup.remove_repeats(odd.withColumnRenamed("SCORE", "N_Bytes"), kept="left")
    assert out.columns[-5:] == ["n_bytes_", "n_removed", "n_spans", "kept_sha256", "left"]
    rows = out.collect()
    assert len(rows) == odd.count()
    assert all((r["left"] is None) == (r["text"] is None) for r in rows)
    assert [r["n_removed"] for r in rows if r["doc_id"] is None] == [0]
    assert suffix_dedup.remove_repeats(empty).count() == 0


def brute_vectors(rows, least=0.98):
    good = {}
    for i, v, label in rows:
        if v is not None and label is not None and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0):
            good[i] = (np.array(v, float), label)
    parent, links = {i: i for i, _, _ in rows}, {i: 0 for i, _, _ in rows}
    for i, (x, a) in good.items():
        for j, (y, b) in good.items():
            if i < j and a == b and len(x) == len(y) and x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= least:
                links[i] += 1
                links[j] += 1
                r = [i, j]
                while parent[r[0]] != r[0]:
                    r[0] = parent[r[0]]
                while parent[r[1]] != r[1]:
                    r[1] = parent[r[1]]
                parent[max(r)] = min(r)
    for i in parent:
        r = i
        while parent[r] != r:
            r = parent[r]
        parent[i] = r
    return {i: (links[i], parent[i]) for i in parent}


def test_near_vectors_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 9)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(40, 12))
    rows = [(i, (base[i % 40 if i % 3 else 0] + rng.normal(size=12) * 0.06 * rng.random()).tolist(), i % 2) for i in range(200)]
    rows += [(200 + i, (base[1] * (1 + i)).tolist(), 0) for i in range(12)] + [(220 + i, base[2].tolist(), 1) for i in range(12)]
    nan, inf = float("nan"), float("inf")
    rows += [(300, None, 0), (301, [0.0] * 12, 0), (302, [1.0, None] * 6, 0), (303, [nan] * 12, 0), (304, [inf] * 12, 0), (305, [], 0), (306, base[2].tolist(), None), (307, base[2, :8].tolist(), 1), (308, (base[2] * 1e300).tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    out = embedding_dedup.near_vectors(df).collect()
    expected = brute_vectors([r for r in rows if r[0] != 308])
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in out}
    twin = got.pop(308)
    assert twin[1] == expected[220][1]
    assert {i: c for i, (_, c) in got.items()} == {i: c for i, (_, c) in expected.items()}
    assert all(abs(got[i][0] - expected[i][0]) <= 1 for i in got)  # the twin is not in the brute-force rows
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in out)
    assert embedding_dedup.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize("hashes", [2, 4, 6])
def test_pairs_at_the_threshold_meet_however_many_hashes(hashes):
    used, tables = embedding_dedup.tables_for(64, hashes, 0.98)
    assert used == hashes and tables >= embedding_dedup.TABLES
    rng = np.random.default_rng(5)
    x, z = (embedding_dedup.unit(rng.normal(size=(2000, 64))) for _ in range(2))
    z = embedding_dedup.unit(z - (x * z).sum(axis=1, keepdims=True) * x)
    with np.errstate(over="ignore"):
        a, b = (embedding_dedup.bucket_keys(v, used, tables) for v in (x, 0.98 * x + np.sqrt(1 - 0.98**2) * z))
    met = (a[:, :, :1] == b) | (b[:, :, :1] == a)
    assert met.any(axis=(1, 2)).all()
    assert (1 - met.any(axis=2).mean()) ** tables <= 2 * embedding_dedup.MISS


def test_low_thresholds_are_compared_in_full(spark):
    assert embedding_dedup.tables_for(64, 3, -0.2) == (0, 1)
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=16).tolist(), 0) for i in range(60)]
    out = embedding_dedup.near_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"), least=-0.2)
    x = embedding_dedup.unit(np.array([r[1] for r in rows]))
    links = (x @ x.T >= -0.2).sum(axis=1) - 1
    assert [r["n_links"] for r in sorted(out.collect())] == links.tolist()


def test_an_id_with_several_vectors_links_by_each(spark):
    a, b, c = np.eye(12)[:3]
    rows = [(1, a, 0), (1, b, 0), (1, a, 1), (1, -0.0 * a, 0), (2, a + 0.01 * b, 0), (3, b + 0.01 * c, 0), (4, a, 1), (5, b, 0), (5, c, 0), (6, c, 0), (7, b, 1)]
    df = spark.createDataFrame([(i, v.tolist(), k) for i, v, k in rows], "vec_id bigint, embedding array<double>, label int")
    for pieces in (1, 5):
        out = sorted(tuple(r) for r in embedding_dedup.near_vectors(df.repartition(pieces)).collect())
        assert out == [
            (1, 0, 1, True), (1, 1, 1, True), (1, 1, 1, True), (1, 2, 1, True), (2, 1, 1, False), (3, 2, 1, False),
            (4, 1, 1, False), (5, 1, 5, True), (5, 2, 1, False), (6, 1, 5, False), (7, 0, 7, True),
        ]


def test_embedding_query_against_brute_force_on_planted_links(spark, tmp_path):
    rng = np.random.default_rng(7)
    base = rng.normal(size=(300, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    rows = [base[i] for i in range(300)]
    for i in range(240):  # pairs on both sides of the threshold, chains, exact copies
        other = rng.normal(size=64)
        other -= (other @ base[i]) * base[i]
        cosine = rng.choice([0.975, 0.979, 0.9801, 0.981, 0.99, 1.0])
        near = cosine * base[i] + (1 - cosine**2) ** 0.5 * other / np.linalg.norm(other)
        rows += [near * rng.choice([0.5, 1, 7])] + ([near + 0.1 * rng.normal(size=64) / 8] if i % 3 == 0 else [])
    labels = [int(k) for k in rng.integers(0, 2, len(rows))]
    labels[300:500] = [labels[i] for i in range(200)]
    table = [(i, x.astype(np.float32).tolist(), k) for i, (x, k) in enumerate(zip(rows, labels))]
    spark.createDataFrame(table, "vec_id bigint, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    x = np.array([r[1] for r in table], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    linked = (x @ x.T >= 0.98) & (np.array(labels)[:, None] == np.array(labels)[None, :])
    np.fill_diagonal(linked, False)
    assert linked.sum() > 200
    component = np.arange(len(x))
    while True:
        lowest = np.minimum(component, np.where(linked, component[None, :], len(x)).min(axis=1))
        if (lowest == component).all():
            break
        component = lowest
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in op2_embedding_dedup(spark, str(tmp_path)).collect()}
    assert got == {i: (int(linked[i].sum()), int(component[i]), bool(component[i] == i)) for i in range(len(x))}


def test_grams_of_long_texts_in_pieces(monkeypatch):
    rng = np.random.default_rng(3)
    parts = [rng.integers(97, 100, n).astype(np.uint8).tobytes() for n in (0, 5000, 99, 100, 0, 700, 1, 2500)]
    parts[5] = parts[1][1000:1700]
    sizes = np.array([len(p) for p in parts])
    block = np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes, sizes
    with np.errstate(over="ignore"):
        whole = suffix_dedup.placed_grams(*block)
        at, gram = suffix_dedup.fingerprints(*block)
        assert (whole[0] == at).all() and (whole[1] == gram).all() and len(at) > 150
        for size in (1, 37, 100, 250, 4096):
            monkeypatch.setattr(suffix_dedup, "_PIECE_BYTES", size)
            assert all((a == b).all() for a, b in zip(suffix_dedup.placed_grams(*block), whole, strict=True))


def _block(rng, letters=3):
    parts = [rng.integers(97, 97 + letters, n).astype(np.uint8).tobytes() for n in (0, 5000, 99, 100, 0, 700, 1, 2500, 300)]
    parts[5] = parts[1][1000:1700]
    parts[8] = b"z" * 300
    sizes = np.array([len(p) for p in parts])
    return parts, (np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes) - sizes, sizes)


@pytest.mark.parametrize("piece", [37, 1 << 14])
def test_each_string_lies_in_the_region_of_one_gram(monkeypatch, piece):
    monkeypatch.setattr(suffix_dedup, "_PIECE_BYTES", piece)
    parts, block = _block(np.random.default_rng(4))
    with np.errstate(over="ignore"):
        at, gram, owner, begin, end, digest = suffix_dedup.placed_grams(*block)
    strings = [(o, k) for o, a, b in zip(owner, begin - block[1][owner], end - block[1][owner]) for k in range(a, b - 99)]
    assert sorted(strings) == [(o, k) for o, p in enumerate(parts) for k in range(len(p) - 99)]
    assert ((at >= end - 100) & (at + 24 <= begin + 100)).all()
    chosen = {}  # equal strings choose an equal gram at the same place
    for g, place, a, b in zip(gram, at, begin, end):
        for k in range(a, b - 99):
            assert chosen.setdefault(block[0][k : k + 100].tobytes(), (g, place - k)) == (g, place - k)
    same = {}
    for d, place, a, b in zip(digest, at, begin, end):
        assert same.setdefault(d, (place - a, block[0][a:b].tobytes())) == (place - a, block[0][a:b].tobytes())


def test_a_shard_searches_only_what_may_be_alike():
    rng = np.random.default_rng(6)
    gram = rng.integers(97, 123, 24).astype(np.uint8).tobytes()
    text = lambda n: rng.integers(97, 123, n).astype(np.uint8).tobytes()
    before, after = text(76), text(76)
    cases = [text(76) + gram + text(76) for _ in range(40)]  # only the gram in common
    shared = [(20, 70), (70, 20), (76, 76), (0, 76), (76, 0), (50, 26)]
    cases += [text(76 - a) + before[76 - a :] + gram + after[:b] + text(76 - b) for a, b in shared]
    data = np.frombuffer(b"".join(cases), np.uint8)
    begin = np.arange(len(cases)) * 176
    with np.errstate(over="ignore"):
        found, low, high = suffix_dedup._alike(data, np.full(len(cases), 5), begin + 76, begin, begin + 176)
        assert not len(suffix_dedup._alike(data, np.arange(len(cases)), begin + 76, begin, begin + 176)[0])
    assert found.tolist() == list(range(40, 46))
    strings = lambda i, a, b: {cases[i][k : k + 100] for k in range(a, b - 99)}
    everywhere = {i: strings(i, 0, 176) for i in range(len(cases))}
    for i, a, b in zip(found, low - begin[found], high - begin[found]):
        others = set().union(*(s for j, s in everywhere.items() if j != i))
        assert everywhere[i] & others <= strings(i, a, b)
    assert (high - low).sum() < 6 * 176


def test_suffix_keeps_the_columns_asked_for(spark):
    passage = " ".join(f"wörd{i}" for i in range(40))
    rows = [(1, passage, "a"), (2, None, "b"), (3, "x" + passage + "y", "c"), (4, "", "d"), (None, passage, "e"), (5, passage * 2, "f")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").coalesce(1)
    out = suffix_dedup.remove_repeats(df, kept="left", keep=["source", "doc_id"])
    assert out.columns == ["source", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "left"]
    got = out.collect()
    expected = without_repeats([r[:2] for r in rows if r[0] is not None])
    assert {r["doc_id"]: tuple(r)[2:6] for r in got if r["doc_id"]} == expected
    assert {r["source"]: r["left"] for r in got} == {"a": passage, "b": None, "c": "xy", "d": "", "e": passage, "f": ""}
