import hashlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textmart.llm.bpe import Bpe, encode_decode
from textmart.llm.token_counts import count_tokens

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "", "  \t\n", "Hello, World! it's 'single don'T 123 4.5", "a<|endoftext|>B <|startoftext|>", "ΑΣ Σας İstanbul ß ǅ \x85 \x1c x\x00123 ａｂ",
    "aaaaaaaaaaaaaaaaaaa aaa aa", "日本語 テスト ½ ٣٤ é", "x" * 30_000, "le ré éau été ſŉ Ÿ", "the the the", "the the the", None, "word " * 5_000, "e\u0301 NFC", "\ufeffbom \u200b zero",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_rounds_equal_the_library(library):
    texts = [t or "" for t in TEXTS]
    mine = Bpe.load(PATH)
    for text, coded in zip(texts, mine.encode(texts)):
        ids = np.frombuffer(coded, "<u4")
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text[:50]
        assert mine.decode(ids).decode() == library.decode(ids.tolist(), skip_special_tokens=False)


def test_unsafe_merges_are_taken_one_by_one():
    # "bc" + "d" outranks "b" + "c": each merge of the latter may start one of the former.
    mine = Bpe.load(PATH)
    assert mine.at_once.all()
    mine.at_once[:] = False
    everywhere = Bpe.load(PATH)
    words = [w.encode() for w in ("banana", "aaaaaaa", "mississippi", "thththth", "z")]
    for a, b in zip(mine.merge(words), everywhere.merge(words)):
        assert a.tolist() == b.tolist()


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "extra", 7) for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, n_bytes int").repartition(3)


def test_encode_decode_rows(docs, library):
    out = {r.doc_id: r for r in encode_decode(docs, PATH, ids="ids", decoded="plain").collect()}
    assert len(out) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        ids = library.encode(text or "", add_special_tokens=False).ids
        plain = library.decode(ids, skip_special_tokens=False)
        assert (out[i].ids, out[i].n_tokens, out[i].plain) == (ids, len(ids), plain)
        assert out[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert out[i].decoded_sha256 == hashlib.sha256(plain.encode()).hexdigest()


@pytest.mark.parametrize("head", [0, 5, 200_000])
def test_counts_do_not_depend_on_the_head(docs, library, head):
    out = {r.doc_id: r for r in count_tokens(docs, PATH, head_words=head).collect()}
    assert len(out) == len(TEXTS)
    for i, text in enumerate(TEXTS):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        assert (out[i].n_tokens, out[i].n_bytes, out[i].over_limit) == (n, len((text or "").encode()), n > 2048)


def test_repeated_ids_and_empty_tables(spark):
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.n_tokens) for r in count_tokens(twice, PATH).collect()) == [(0, 1), (1, 2), (1, 2)]
    assert count_tokens(twice.limit(0), PATH).collect() == []
    assert encode_decode(twice.limit(0), PATH).collect() == []
    assert encode_decode(twice, PATH).count() == 3


def test_other_files_are_refused():
    with pytest.raises((ValueError, KeyError, TypeError)):
        Bpe.load(public_tokenizers.path("byte_bpe_50k.json"))


def test_frequent_words_are_bounded_and_long_ones_among_them(spark):
    from textmart.llm.token_counts import COMMON, frequent_words

    rows = [(f"w{i}", 1 + 10_000 // (i + 1), 1) for i in range(500)] + [("=" * 80, 5000, 20), ("-" * 90, 2, 20), ("_" * 9000, 9000, 99)]
    counted = spark.createDataFrame(rows, "piece_of string, total long, pieces long")
    total = sum(r[1] for r in rows)
    for n in (0, 1, 7, 100, 10_000):
        got = {r.piece_of for r in frequent_words(counted, n).collect()}
        often = {w for w, t, _ in rows if t > total / COMMON and len(w) <= 4096}
        short = {w for w in got - often}
        assert often <= got and len(short) <= n and not any(len(w) > 4096 for w in got)
        rest = [t for w, t, _ in rows if w not in got and len(w) <= 32]
        assert not short or not rest or min(t for w, t, _ in rows if w in short) > max(rest)
    assert "=" * 80 in got and len(got) == 501
    assert frequent_words(counted.limit(0), 5).collect() == []
