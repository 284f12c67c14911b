import hashlib

import numpy as np
import public_tokenizers
import pytest
from conftest import ODD_TEXTS, SF_DIR
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tablekit.llm.bpe import Bpe, encode_decode, read_definition
from tablekit.llm.queries import op3_bpe, op5_token_files
from tablekit.llm.token_files import Reader, Writer, packed, read_token_files, token_folder, unpacked, write_token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
THEIRS, MINE = Tokenizer.from_file(PATH), Bpe(read_definition(PATH))


def ids_of(text):
    return THEIRS.encode(text or "", add_special_tokens=False).ids


def digests(text):
    ids = ids_of(text)
    decoded = THEIRS.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n\t'aeiost1 é")), max_size=60))
def test_ids_and_text_as_the_tokenizers_library(text):
    ids = MINE.encode(text)
    assert ids.tolist() == ids_of(text)
    assert MINE.decode(ids) == THEIRS.decode(ids.tolist(), skip_special_tokens=False)


def test_query_on_whole_documents(spark):
    texts = dict(spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect())
    rows = op3_bpe(spark, SF_DIR).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows} == {i: digests(t) for i, t in texts.items()}


def test_odd_rows_and_names(odd, empty):
    out = encode_decode(odd.withColumnRenamed("SCORE", "N_Tokens"), PATH, ids="ids", decoded="back")
    assert out.columns[-5:] == ["n_tokens_", "ids_sha256", "decoded_sha256", "ids", "back"]
    for r in out.collect():
        assert (r["n_tokens_"], r["ids_sha256"], r["decoded_sha256"]) == digests(r["text"])
        assert r["ids"] == ids_of(r["text"]) and r["back"] == (r["text"] or "")
    assert encode_decode(empty, PATH).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        Bpe(read_definition(public_tokenizers.path("word_bpe_49k.json")))


@pytest.mark.parametrize("bits", [1, 5, 8, 15, 16, 17, 20])
def test_packing_and_random_access(tmp_path, bits):
    ids = np.random.default_rng(bits).integers(0, 1 << bits, 1000).astype(np.uint32)
    assert (unpacked(packed(ids, bits), bits, len(ids)) == ids).all()
    path = tmp_path / "x.bin"
    writer = Writer(path.open("wb"), bits, block=64)
    for part in np.split(ids, [0, 3, 3, 200, 777]):
        writer.add(part)
    writer.close()

    class Sized:
        def __init__(self):
            self.file = path.open("rb")
            self.seek, self.read = self.file.seek, self.file.read

        def size(self):
            return path.stat().st_size

    reader = Reader(Sized())
    for start, count in ((0, 1000), (0, 0), (63, 2), (64, 64), (999, 1), (1000, 0)):
        assert (reader.ids(start, count) == ids[start : start + count]).all()
    with pytest.raises(IndexError):
        reader.ids(999, 2)


def test_token_files_of_odd_rows(odd, empty):
    import zlib

    rows = {r["id"]: r for r in read_token_files(write_token_files(odd.where("doc_id is not null").dropDuplicates(), token_folder(odd), PATH)).collect()}
    start = 0
    for i, text in enumerate(ODD_TEXTS):
        ids = [*ids_of(text), 0]
        assert (rows[i]["start"], rows[i]["n_tokens"], rows[i]["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert read_token_files(write_token_files(odd, token_folder(odd), PATH)).count() == odd.count()
    assert read_token_files(write_token_files(empty, token_folder(empty), PATH)).count() == 0


def test_token_file_query_against_the_library(spark):
    import zlib

    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expected, start = {}, 0
    for r in documents:
        ids = np.array([*theirs.encode(r["text"] or "", add_special_tokens=False).ids, 0], "<u4")
        expected[r["doc_id"]] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in op5_token_files(spark, SF_DIR).collect()}
    assert got == expected
