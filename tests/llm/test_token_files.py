import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from weavegraph.llm import simple8b, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.just(0), st.integers(0, 49407), st.integers(0, 2**64 - 1)), max_size=400), st.sampled_from([1, 7, 64, 1024]))
def test_round_trip(ids, block):
    values = np.array(ids, dtype=np.uint64)
    words, first = simple8b.encode(values, block)
    assert simple8b.decode(words, first, len(ids), block).tolist() == ids


def test_round_trip_long_and_dense():
    rng = np.random.default_rng(1)
    values = np.concatenate([np.zeros(3000), rng.integers(0, 2, 5000), rng.integers(0, 40000, 20000), np.ones(700)]).astype(np.uint64)
    words, first = simple8b.encode(values)
    assert (simple8b.decode(words, first, len(values)) == values).all() and len(words) < len(values) / 2.5
    one = simple8b.decode(words[first[5] : first[6]], first[5:7] - first[5], 1024)
    assert (one == values[5 * 1024 : 6 * 1024]).all()


def test_more_blocks_than_go_at_once(monkeypatch):
    rng = np.random.default_rng(2)
    values = np.where(rng.random(50_001) < 0.01, rng.integers(0, 2**63, 50_001), rng.integers(0, 3000, 50_001)).astype(np.uint64)
    want = simple8b.encode(values, 64)
    assert (simple8b.decode(*want, len(values), 64) == values).all()
    monkeypatch.setattr(simple8b, "AT_ONCE", 3)
    words, first = simple8b.encode(values, 64)
    assert (words == want[0]).all() and (first == want[1]).all() and (simple8b.decode(words, first, len(values), 64) == values).all()


def test_words_give_the_ids_of_whole_texts():
    t, encode = Tokenizer.from_file(PATH), token_files.Encoder(PATH)
    texts = ["", " a  b\n\n", "Don't STOP, we'll go!! 12345 o'clock's", "Straße ÀÉÎ ΣΊΣΥΦΟΣ İstanbul éá", "x y z\x1c\x85w", "<|endoftext|> a<|startoftext|>b", "日本語 テスト한국어 ª º µ ß", "a.b,c ... ?! (d) e-f", "'s 's't x's", "́a ﬁ Ǆ"]
    assert encode.wordwise
    texts += ["a\x01b c\x01", "re%%% a$$$. (b)x_y _a_ 1.5e3*", "e\u0301, n\u0303. ²! Ⅷ; ÿ?"]
    want = [t.encode(x, add_special_tokens=False).ids for x in texts]
    for most in (250_000, 3):
        encode = token_files.Encoder(PATH, most)
        for _ in range(2):
            ids, lengths = encode(texts)
            assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == want
    assert [len(x) for x in encode([])] == [0, 0]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\x01.,'aB1é\u0301日*<_"), st.characters(exclude_categories=("Cs",)))), max_size=8))
def test_any_text_gives_the_ids_of_the_library(texts):
    t = Tokenizer.from_file(PATH)
    ids, lengths = token_files.encoder(PATH)(texts)
    assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])][: len(texts)] == [t.encode(x, add_special_tokens=False).ids for x in texts]


def digest(rows, t):
    out, start = [], 0
    for d, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], dtype="<u4")
        out.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_files(spark, sf_dir):
    t = Tokenizer.from_file(PATH)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [(r.doc_id, r.text) for r in docs.collect()] + [(5, None), (5, ""), (-3, "word " * 9000), (None, "No id"), (7, "same"), (7, "same")]
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    for size in (4 << 20, 20_000):
        got = token_files.token_digest(table, tokenizer=PATH, file_ids=size).collect()
        assert sorted(map(tuple, got), key=lambda r: r[1]) == digest(rows, t)
    assert token_files.token_digest(table.limit(0), tokenizer=PATH).count() == 0


def test_clashing_columns_and_one_id_for_all(spark):
    t = Tokenizer.from_file(PATH)
    rows = [(None, f"text {i % 7} " * 3, i, "x") for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id bigint, text string, tie int, head string").repartition(4)
    got = sorted(map(tuple, token_files.token_digest(table, tokenizer=PATH, file_ids=50).collect()), key=lambda r: r[1])
    assert got == digest([r[:2] for r in rows], t)
