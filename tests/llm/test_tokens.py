"""Encoding, token files and decontamination: exact against the libraries and brute force."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers as P
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import bpe, decontaminate, tokenfile

RANKS, FILE = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
ENC = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load_ranks(RANKS), special_tokens={})
TEXTS = ["", None, "a", " a", "a ", "  a  b\n\n c", "it's  we'll  　x y   z", "\x85 a\x85 b", "\x1c a \x1f\x1c b", "x" * 5000, " " * 3000, "é 日本語 😀 <|endoftext|> <|endoftext|>", "naïve—“q” …", "1 22 333\t4\r\n5", "é à" * 800]


def test_encoding_equals_the_library(spark):
    docs = spark.createDataFrame([(i, t, 5) for i, t in enumerate(TEXTS)] + [(None, "z", 1)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: r for r in bpe.digests(docs, RANKS, P.PATTERN).collect()}
    encoded = bpe.encode(docs, RANKS, P.PATTERN)
    ids = {r.doc_id: r for r in encoded.collect()}
    back = {r.doc_id: bytes(r.content) for r in bpe.decode_ids(encoded, RANKS, P.PATTERN).collect()}
    for i, t in enumerate(TEXTS):
        want, raw = ENC.encode_ordinary(t or ""), (t or "").encode()
        assert ids[i].ids == want and back[i] == raw and ids[i].decoded == (t or "")
        assert (got[i].n_tokens, got[i].ids_sha256, got[i].decoded_sha256) == (len(want), hashlib.sha256(",".join(map(str, want)).encode()).hexdigest(), hashlib.sha256(raw).hexdigest())
    assert bpe.digests(docs.filter("false"), RANKS, P.PATTERN).count() == 0


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aé' \n\t  　\x85\x1c.1日—"), max_size=30), min_size=1, max_size=4))
def test_any_mixture_of_white_space(texts):
    encoder, _ = bpe.tiktoken_encoder(RANKS, P.PATTERN)
    encoder.reset()
    raw = [t.encode() for t in texts]
    ids, n = encoder(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))))
    assert ids.tolist() == [i for t in texts for i in ENC.encode_ordinary(t)] and n.tolist() == [len(ENC.encode_ordinary(t)) for t in texts]


def test_files_round_trip(spark, tmp_path):
    tok = Tokenizer.from_file(FILE)
    tok.encode_special_tokens = True
    rows = [((i * 37) % 101, t) for i, t in enumerate(TEXTS * 3)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, shard string").repartition(3)
    path = f"file://{tmp_path}/ids"
    tokenfile.write(docs, path, FILE)
    want, start = {}, 0
    for i, t in sorted(rows, key=lambda r: r[0]):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        want[i] = (start, ids)
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in tokenfile.summary(spark, path).collect()} == {i: (s, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, (s, x) in want.items()}
    assert {r.doc_id: r.ids for r in tokenfile.read(spark, path).collect()} == {i: x for i, (_, x) in want.items()}


def test_files_hold_added_tokens_as_the_library_has_them(spark, tmp_path):
    tok, end = Tokenizer.from_file(FILE), "<|endoftext|>"
    texts = [*TEXTS, f"end of one {end} next one", end, f"{end}{end}", f"{end} a", f"a\n\n{end}  b {end}", f"<|endof{end}text|>", "<|endof", "text|>", f"x 　{end}　 y"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    path = f"file://{tmp_path}/ids"
    tokenfile.write(docs, path, FILE, recognise=True)
    want = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 0] for i, t in enumerate(texts)}
    assert {r.doc_id: r.ids for r in tokenfile.read(spark, path).collect()} == want
    assert 50256 in want[len(TEXTS)]


def test_files_of_nothing_and_of_null_ids(spark, tmp_path):
    docs = spark.createDataFrame([(None, "a"), (1, "b"), (1, "b")], "doc_id long, text string")
    tokenfile.write(docs.filter("false"), f"file://{tmp_path}/a", FILE)
    assert tokenfile.summary(spark, f"file://{tmp_path}/a").count() == 0
    tokenfile.write(docs, f"file://{tmp_path}/b", FILE)
    assert sorted((r.start, r.doc_id) for r in tokenfile.summary(spark, f"file://{tmp_path}/b").collect()) == [(0, None), (2, 1), (4, 1)]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 300), max_size=700), min_size=1, max_size=5), st.integers(9, 18))
def test_huffman_blocks(rows, limit):
    counts = np.bincount([x for r in rows for x in r] or [0], minlength=301)
    sizes = tokenfile.lengths(counts, limit)
    assert sizes.max() <= limit and (2.0 ** -sizes[sizes > 0].astype(float)).sum() <= 1 + 1e-12
    n = np.array([len(r) for r in rows])
    ids = np.array([x for r in rows for x in r], np.int64)
    data, _, runs, _ = tokenfile.pack(ids, np.concatenate(([0], np.cumsum(n))), tokenfile.codes(sizes), sizes)
    assert tokenfile.unpack(data, n, runs, *tokenfile.table(sizes)).tolist() == ids.tolist()


def test_lengths_are_optimal():
    assert sorted(tokenfile.lengths(np.array([1, 1, 2, 4, 8, 0]), 18).tolist()) == [0, 1, 2, 3, 4, 4]
    assert sorted(tokenfile.lengths(np.array([1, 1, 2, 4, 8]), 3).tolist()) == [2, 2, 2, 3, 3] or tokenfile.lengths(np.array([1, 1, 2, 4, 8]), 3).max() == 3


WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def _w(s):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), s or ""))


def _brute(text, items, window):
    w, hit, found = _w(text), set(), set()
    for i, t in items:
        v = _w(t)
        for x in [v[j : j + window] for j in range(len(v) - window + 1)] if len(v) >= window else [v] if v else []:
            for j in range(len(w) - len(x) + 1):
                if w[j : j + len(x)] == x:
                    hit.update(range(j, j + len(x)))
                    found.add(str(i))
    return len(w), len(hit), sorted(found)


def _bench():
    rng = np.random.default_rng(2)
    word = lambda n: " ".join(rng.choice(list("abcde"), n))
    items = [(i, word(n)) for i, n in enumerate([3, 4, 5, 5, 7, 9, 12])] + [(20, ""), (21, None), (None, "a"), (22, "é-1"), (9, "a b, c d e")]
    docs = [(i, word(n)) for i, n in enumerate([0, 1, 5, 40, 200, 400])] + [(90, None), (91, "x É-1 y"), (92, "x é 1 Y"), (None, "a b c d e"), (3, "a")]
    return items, docs


def test_decontamination_matches_brute_force(spark, monkeypatch):
    items, docs = _bench()
    di = spark.createDataFrame(items, "item_id long, text string")
    dd = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, items string, n_hit int")
    want = sorted(((i, *_brute(t, [x for x in items if x[0] is not None], 5)) for i, t in docs), key=str)
    read = lambda: sorted(((r.doc_id, r.n_words, r.n_hit, r.items) for r in decontaminate.scan(dd, di, window=5).collect()), key=str)
    assert read() == want
    real = decontaminate.automata
    monkeypatch.setattr(decontaminate, "automata", lambda *a: real(*a, block_bytes=20))  # a benchmark of several blocks
    assert read() == want


def test_removal(spark):
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "Keep this. One, two three-four FIVE six! And that too, with more words here", "x"), (2, "one two three four five six.", "y"), (3, None, "z"), (4, "clean", "w")], "doc_id long, text string, lang string")
    got = {r.doc_id: (r.text, r.lang) for r in decontaminate.remove(docs, items, window=5).collect()}
    assert got == {1: ("Keep this. ! And that too, with more words here", "x"), 3: (None, "z"), 4: ("clean", "w")}
    assert decontaminate.remove(docs, items.filter("false")).count() == 4 and decontaminate.scan(docs, items.filter("false")).count() == 4
    assert decontaminate.scan(docs.filter("false"), items).count() == 0


def test_removal_with_several_blocks(spark, monkeypatch):
    a, b, c = "a1 a2 a3 a4 a5 a6", "b1 b2 b3 b4 b5 b6", "a4 a5 a6 c1 c2 c3"
    items = spark.createDataFrame([(1, a), (2, b), (3, c)], "item_id long, text string")
    rows = [(1, f"{a} {b} x y z"), (2, f"p q r s t u v, {a} c1 c2 c3; w"), (3, None), (4, "clean\n"), (5, f"é p q r s t u v w x {b}!"), (None, "n")]
    docs = spark.createDataFrame([(i, t, "l", "k") for i, t in rows], "doc_id long, text string, lang string, row string")
    read = lambda: sorted(map(tuple, decontaminate.remove(docs, items, window=5, max_coverage=0.6).collect()), key=str)
    want = read()
    assert {r[0]: r[1] for r in want} == {2: "p q r s t u v, ; w", 3: None, 4: "clean\n", 5: "é p q r s t u v w x !", None: "n"}
    real = decontaminate.automata
    monkeypatch.setattr(decontaminate, "automata", lambda *x: real(*x, block_bytes=10))
    assert read() == want


def test_decontamination_in_several_passes(spark, monkeypatch):
    rng = np.random.default_rng(9)
    vocab = [f"w{i}" for i in range(12)]
    items = spark.createDataFrame([(f"i{i}", " ".join(rng.choice(vocab, rng.integers(1, 25)))) for i in range(20)], "item_id string, text string")
    docs = spark.createDataFrame([(i, " ".join(rng.choice([*vocab, "x", "y"], 60))) for i in range(30)], "doc_id long, text string")
    read = lambda: (sorted(map(str, decontaminate.scan(docs, items, window=4).collect())), sorted(map(str, decontaminate.remove(docs, items, window=4, max_coverage=0.9).collect())))
    real, want = decontaminate.automata, read()
    monkeypatch.setattr(decontaminate, "automata", lambda *a: real(*a, block_bytes=60, group=2))
    assert len(list(decontaminate.automata(items, "item_id", "text", 4))) > 2
    assert read() == want
