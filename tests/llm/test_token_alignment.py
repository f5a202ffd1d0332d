import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import SHAPE, documents, odd_rows
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from revspine.llm import queries
from revspine.llm.common import table
from revspine.llm.packing import _BYTE_SYMBOLS
from revspine.llm.token_alignment import align, alignments, crossings, digest, sides

A, B = queries.TOKENIZER, queries.PIECE_TOKENIZER
TOK = Tokenizer.from_file(A)
TOK.encode_special_tokens = True
SP = SentencePieceProcessor(model_file=B)
BYTE = {chr(c): b for b, c in _BYTE_SYMBOLS.items()}


def tokens(text):
    """Ids and bytes of both sides by the libraries alone."""
    a = TOK.encode(" " + text, add_special_tokens=False).ids
    b = SP.encode(text)
    bytes_a = [bytes(BYTE[c] for c in TOK.id_to_token(i)) for i in a]
    bytes_b = [bytes([int(SP.id_to_piece(i)[3:5], 16)]) if SP.is_byte(i) else SP.id_to_piece(i).replace("▁", " ").encode() for i in b]
    whole = (" " + text).encode()
    return (a, b, bytes_a, bytes_b) if text and b"".join(bytes_a) == whole == b"".join(bytes_b) else ([], [], [], [])


def links_and_groups(a, b, bytes_a, bytes_b):
    """Every pair of overlapping tokens, and the groups between common ends."""
    def spans(parts):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        return list(zip([0, *ends], ends))

    sa, sb = spans(bytes_a), spans(bytes_b)
    links = [(x, y) for x, (s, e) in zip(a, sa) for y, (t, u) in zip(b, sb) if s < u and t < e]
    groups, now = [], ([], [])
    common = {e for _, e in sa} & {e for _, e in sb}
    for end in sorted(common):
        now = [i for i, (_, e) in zip(a, sa) if e <= end], [i for i, (_, e) in zip(b, sb) if e <= end]
        done = sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups)
        groups.append((now[0][done[0] :], now[1][done[1] :]))
    return links, groups


def brute(texts):
    found = [links_and_groups(*tokens(t or "")) for _, t in texts]
    counts = Counter(x for links, _ in found for x in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    out = []
    for (i, _), (links, groups) in zip(texts, found):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), len(links), sum(counts[p] == best[p[1]] for p in links),
                    sum(counts[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _texts():
    r = random.Random(4)
    texts = ["", " ", "  a  b ", "a\n  b\n\n", "<s></s><unk><0x0A> <|endoftext|>", "x▁y", "ﬁ ½ é́ Å 漢字 кот 🎉", "\x00a\tb　c\xa0d", "it's we'll", "trailing "]
    for k in range(150):
        top = [127, 256, 0x250, 0x2100, 0x1F700][k % 5]
        points = (r.randrange(top) if r.random() < 0.6 else r.choice([32, 32, 39, 115, 10, 9, 0xA0, 48]) for _ in range(r.randrange(40)))
        texts.append("".join(chr(c) for c in points if not 0xD800 <= c < 0xE000))
    return texts


def test_query(spark):
    """Against counts that are made by the same links (all pairs of a whole table are too many for the plain version)."""
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    out = queries.op11_token_alignment(spark, sf)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    by = {r[0]: r for r in rows(out)}
    assert len(by) == len(docs)
    found = {}
    for i, t in docs:
        a, b, bytes_a, bytes_b = tokens(t or "")
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]), np.cumsum([len(x) for x in bytes_b])
        links, x, y = [], 0, 0
        while x < len(a) and y < len(b):
            links.append((a[x], b[y]))
            x, y = x + (ends_a[x] <= ends_b[y]), y + (ends_b[y] <= ends_a[x])
        found[i] = a, b, links, len(set(ends_a.tolist()) & set(ends_b.tolist()))
    counts = Counter(p for _, _, links, _ in found.values() for p in links)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(n, best.get(b, 0))
    for i, (a, b, links, groups) in found.items():
        assert by[i][1:7] == (len(a), len(b), groups, len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links))


@pytest.mark.parametrize("frequent", [0, 20, 1 << 18])
def test_equals_brute_force(spark, frequent):
    """With all pairs through the join, most of them, and none."""
    texts = [(k if k % 9 else None, t) for k, t in enumerate(_texts())]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(5)
    assert rows(digest(df, A, B, frequent=frequent)) == brute(texts)


def test_odd_rows(spark):
    odd = [(i, t) for i, t, *_ in odd_rows() if len(t or "") < 1000]
    assert rows(digest(documents(spark, [(i, t) for i, t in odd]), A, B)) == brute(odd)
    long_ = " ".join(f"w{k % 997}" for k in range(60_000)) + "x" * 100_000
    df = documents(spark, [(1, long_), (2, "a"), (3, None)])
    out = {r.doc_id: r for r in digest(df, A, B).collect()}
    a, b = TOK.encode(" " + long_, add_special_tokens=False).ids, SP.encode(long_)
    assert (out[1].n_a, out[1].n_b, out[3].n_a, out[3].groups_sha256) == (len(a), len(b), 0, "")
    assert digest(spark.createDataFrame([], SHAPE), A, B).count() == 0


def test_groups_as_rows(spark):
    texts = [(k, t) for k, t in enumerate(_texts())]
    got = {}
    for r in alignments(spark.createDataFrame(texts, "doc_id long, text string"), A, B).collect():
        got.setdefault(r.doc_id, {})[r.group_no] = (list(r.a_ids), list(r.b_ids))
    for i, t in texts:
        want = links_and_groups(*tokens(t))[1]
        assert [got.get(i, {})[k] for k in sorted(got.get(i, {}))] == want


@pytest.mark.parametrize("work, lanes", [(1, 1), (3, 2), (256, 4096)])
def test_merge_path_with_pieces_of_any_size(work, lanes):
    r = np.random.default_rng(work)
    for _ in range(30):
        end = int(r.integers(1, 200))
        a, b = (np.unique(np.append(r.integers(1, end + 1, r.integers(0, 60)), end)) for _ in range(2))
        at_a, at_b, a_last, b_last = align(a, b, work, lanes)
        sa, sb = np.append(0, a[:-1]), np.append(0, b[:-1])
        want = [(i, j) for i in range(len(a)) for j in range(len(b)) if sa[i] < b[j] and sb[j] < a[i]]
        assert list(zip(at_a.tolist(), at_b.tolist())) == want
        common = set(a.tolist()) & set(b.tolist())
        assert a[a_last].tolist() == sorted(common) == b[b_last].tolist()
    merged = sorted([(x, 0, k) for k, x in enumerate(a.tolist())] + [(x, 1, k) for k, x in enumerate(b.tolist())])
    diagonals = np.arange(len(merged) + 1)
    assert crossings(a, b, diagonals).tolist() == [sum(m[1] == 0 for m in merged[:d]) for d in diagonals.tolist()]


def test_encoders_equal_the_libraries():
    texts = _texts() + ["x" * 30_000, " " * 5000 + "a", "a" + "\n" * 30_000 + "b", "ab" * 30_000]
    own = sides(A, B)
    assert own.fast is not None
    for t, a, b in zip(texts, *own.encode(texts), strict=True):
        want = tokens(t)
        assert np.frombuffer(a, own.width).tolist() == want[0] and np.frombuffer(b, own.width).tolist() == want[1]


def test_extra_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "one two"), (2, "two")], "doc_id long, text string").selectExpr("*", "doc_id AS row", "text AS pair", "doc_id AS n", "text AS b", "text AS rare")
    assert rows(digest(df, A, B, frequent=1)) == brute([(1, "one two"), (2, "two")])
