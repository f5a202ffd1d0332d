import hashlib
import random
import struct

import pytest
from helpers import SHAPE, documents, odd_rows
from tokenizers import Tokenizer

from revspine.llm import queries, word_lexicon
from revspine.llm.common import table
from revspine.llm.word_lexicon import Coder, Encoder, Lexicon, build_lexicon, compile_lexicon, decode, digest, encode, word_counts

PATH = queries.WORD_TOKENIZER
TOK = Tokenizer.from_file(PATH)
OWN = Coder(PATH)


def library(text):
    ids = TOK.encode(text or "", add_special_tokens=False).ids
    return ids, TOK.decode(ids, skip_special_tokens=False)


def want(doc_id, text):
    ids, decoded = library(text)
    return doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents").select("doc_id", "text").collect()
    out = queries.op12_word_lexicon(spark, sf)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert rows(out) == sorted((want(r.doc_id, r.text) for r in docs), key=str)


def _cases():
    r = random.Random(7)
    cases = ["", " \n", "It's WE'LL they'd İI ŉ ﬁ ½²3", "<|endoftext|>x<|startoftext|><|endoftext|>", "<|EndOfText|> < |endoftext|>", "é é Å ΣΑΣ ς", "漢字 кот 🎉", "a\x1cb\x85c\xa0d", "İ", "''s'T"]
    for k in range(2000):
        top = [127, 256, 0x180, 0x250, 0x2100, 0x1F700][k % 6]
        points = (r.randrange(top) if r.random() < 0.6 else r.choice([32, 39, 115, 10, 0x85, 0xA0, 48, 0x301, 0x3A3, 0x130]) for _ in range(r.randrange(25)))
        cases.append("".join(chr(c) for c in points if not 0xD800 <= c < 0xE000))
    return cases


@pytest.mark.parametrize("size", [0, 50, 100_000])
def test_encoder_equals_the_library(size):
    """With no word in the lexicon, with some, and with all of them."""
    cases = _cases()
    words = sorted({w.encode() for c in cases for w in OWN.words(c)})
    words = words[:: max(1, len(words) // size)] if size else []
    lexicon = Lexicon(compile_lexicon([(w, tuple(OWN.merge(w.decode()))) for w in words if len(w) <= 64]))
    for case, (ids, decoded, found) in zip(cases, Encoder(OWN, lexicon).encode(cases), strict=True):
        assert ([int(i) for i in ids.split()], decoded.decode()) == library(case)
        assert [i for f in found for i in f[2]] == library(case)[0]


def test_merging_equals_the_library():
    r = random.Random(1)
    for _ in range(3000):
        word = "".join(r.choice("abcdeinorst" if r.random() < 0.9 else "éß漢'") for _ in range(r.randrange(1, 40)))
        assert OWN.merge(word) == [t.id for t in TOK.model.tokenize("".join(word_lexicon._BYTE_SYMBOLS and chr(word_lexicon._BYTE_SYMBOLS[b]) for b in word.encode()))]


def test_lexicon_is_a_minimal_transducer():
    words = {b"walk": (1,), b"walked": (1, 2), b"walking": (1, 3), b"talk": (4,), b"talked": (4, 2), b"talking": (4, 3), b"a": (), b"walkings": (9, 9)}
    data = compile_lexicon(sorted(words.items()))
    lexicon = Lexicon(data)
    assert lexicon.find([*words, b"", b"wal", b"walkers", b"x", b"talkings"]) == [*words.values(), None, None, None, None, None]
    del words[b"walkings"]
    same_ends = Lexicon(compile_lexicon(sorted(words.items())))
    # start, w/t-a-l, the shared k and its endings: -, e-d, i-n-g; the end state
    assert same_ends.states < sum(map(len, words)) / 2
    one = Lexicon(compile_lexicon(sorted({p + b"tion": (k, 7) for k, p in enumerate([b"a", b"b", b"c", b"dd"])}.items())))
    assert one.states == 7  # start, dd's middle, t-i-o-n-end: the suffix is there once
    empty = Lexicon(compile_lexicon([]))
    assert empty.find([b"a", b""]) == [None, None] and struct.unpack_from("<4q", compile_lexicon([]))[1] == 0


def test_random_lexicons():
    r = random.Random(2)
    for n in (1, 5, 300):
        words = {bytes(r.choices(b"abc\x00\xff", k=r.randrange(1, 9))): tuple(r.choices(range(4), k=r.randrange(4))) for _ in range(n)}
        others = [bytes(r.choices(b"abc\x00\xff", k=r.randrange(0, 9))) for _ in range(500)]
        lexicon = Lexicon(compile_lexicon(sorted(words.items())))
        assert lexicon.find([*words, *others]) == [words.get(w) for w in [*words, *others]]


def test_odd_rows_and_whole_outputs(spark):
    odd = odd_rows() + [(20, "x" * 300_000, "en", "s"), (21, "<|endoftext|>" * 3, "en", "s"), (20, "other", "en", "s")]
    df = documents(spark, odd)
    assert rows(digest(df, PATH)) == sorted((want(i, t) for i, t, *_ in odd), key=str)
    whole = encode(df, PATH, build_lexicon(df, PATH)).collect()
    assert sorted((r.doc_id, list(r.token_ids), r.decoded) for r in whole if r.doc_id) == sorted((i, *library(t)) for i, t, *_ in odd if i)
    back = decode(encode(df, PATH, build_lexicon(df, PATH)).select("token_ids", "decoded"), PATH, decoded="again").collect()
    assert all(r.again == r.decoded for r in back)
    assert digest(spark.createDataFrame([], SHAPE), PATH).count() == 0


def test_counts_cover_all_rows(spark, monkeypatch):
    df = documents(spark, [(k, f"The cat{k % 3} the") for k in range(30)]).repartition(4)
    assert {r.word: r.n for r in word_counts(df, PATH).collect()} == {"the": 60, "cat": 30, "0": 10, "1": 10, "2": 10}


def test_memory_bound_changes_nothing(monkeypatch):
    monkeypatch.setattr(word_lexicon, "REMEMBERED_WORDS", 2)
    monkeypatch.setattr(word_lexicon, "_WORK_CHARS", 10)
    e = Encoder(OWN, Lexicon(compile_lexicon([(b"one", tuple(OWN.merge("one")))])))
    texts = ["one two three", "three four one", "", "one"]
    assert [[int(i) for i in ids.split()] for ids, _, _ in e.encode(texts)] == [library(t)[0] for t in texts]


def test_extra_columns_with_clashing_names(spark):
    df = documents(spark, [(1, "one two"), (2, None)]).selectExpr("doc_id", "text", "text AS word", "doc_id AS n", "text AS n_tokens", "text AS ids_sha256")
    assert rows(digest(df, PATH)) == sorted([want(1, "one two"), want(2, None)], key=str)
