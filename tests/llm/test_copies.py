"""Near copies, lines and passages, against brute force on small tables."""

import re
from collections import Counter

import numpy as np
import pytest

from tessera.llm import _spark, chunkdedup, linededup, minhash

DOCS = "doc_id long, text string, lang string, rep long, set_a string"


def _fold(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def _words(s):
    return re.findall(r"[^\x20\x09-\x0D]+", _fold(s or ""))


def _set(s, k):
    w = _words(s)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def _components(ids, links):
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def _corpus():
    rng = np.random.default_rng(5)
    vocab = [f"w{i}" for i in range(400)]
    texts = ["", None, " \t\n", "one", "One", "a b c", "a b c d e f", "A B c d e f"]
    for size in (6, 20, 21, 60, 200):
        hub = list(rng.choice(vocab, size))
        texts.append(" ".join(hub))
        for edits in (0, 1, 1, 2, 3, 5, 8):
            v = list(hub)
            for p in rng.integers(0, size, edits):
                v[p] = str(rng.choice(vocab))
            texts.append("  ".join(v))
    return list(enumerate(texts))


@pytest.mark.parametrize("k", [4, 5])
def test_near_duplicates_match_brute_force(spark, k):
    rows = [(100 - i, t, "x", 7, "clash") for i, t in _corpus()]
    got = {r.doc_id: r for r in minhash.near_duplicates(spark.createDataFrame(rows, DOCS), shingle=k).collect()}
    sets = {i: _set(t, k) for i, t, *_ in rows}
    links = [(i, j) for i in sets for j in sets if i < j and sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    want = _components(sets, links)
    assert len(links) > 10
    assert {i: (r.n_shingles, r.component_id, r.kept) for i, r in got.items()} == {i: (len(s), want[i], want[i] == i) for i, s in sets.items()}


def test_no_link_in_a_bucket_is_passed_over(spark):
    texts = {}
    for i in range(1500):  # 4 of 5 shingles shared, 8 of 10, 40 of 50, and the same with words elsewhere
        for j, (n, less) in enumerate(((8, 1), (13, 2), (53, 10), (8, 1))):
            w = [f"{i}.{j}.{k}" for k in range(n)]
            texts[10 * i + 2 * j], texts[10 * i + 2 * j + 1] = " ".join(w), " ".join(w[less:] if j == 3 else w[:-less])
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in texts.items()], DOCS).select("doc_id", "text")
    fields = "rep long, n_shingles long, set_a long, set_b long, bands array<long>, " + ", ".join(f"{c} long" for c in minhash._MAP)
    rows = docs.mapInArrow(minhash._sign(4), fields.replace("rep", "doc_id", 1)).withColumnRenamed("doc_id", "rep")
    rows = rows.selectExpr("rep", "rep as part", "n_shingles", *minhash._MAP, "explode(bands) as bucket")
    assert {(r.hi, r.lo) for r in minhash._candidates(rows, 80, 100).collect()} == {(i + 1, i) for i in texts if i % 2 == 0}


def test_near_duplicates_edges(spark):
    empty = spark.createDataFrame([], DOCS)
    assert minhash.near_duplicates(empty).count() == 0
    rows = spark.createDataFrame([(None, "a b", None, None, None), (1, "a b", None, None, None), (1, "a b", None, None, None), (2, "a b", None, None, None)], DOCS)
    got = sorted(((r.doc_id is None, r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(rows).collect()), key=str)
    assert got == [(False, 1, 1, True), (False, 1, 1, True), (False, 2, 1, False), (True, None, None, True)]


def test_components_of_a_long_chain(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 200), (300, 200), (5, 5)]
    got = dict(map(tuple, _spark.components(spark.createDataFrame(pairs, "hi long, lo long")).collect()))
    assert got == {i: 0 for i in range(41)} | {100: 100, 200: 100, 300: 100}


def _lines(rows):
    """Lines with words, in order, each with its place and set."""
    return sorted((i, n, frozenset(_words(x))) for i, t in rows if i is not None for n, x in enumerate((t or "").split("\n")) if _words(x))


def _line_brute(rows):
    gone, first = {}, {}
    for i, n, s in _lines(rows):
        if s in first:
            gone[i, n] = 1
        elif any(100 * len(s & o) >= 80 * len(s | o) for o in first):
            gone[i, n] = 2
        first.setdefault(s, (i, n))
    return gone, first


def test_line_dedup_matches_brute_force(spark):
    rng = np.random.default_rng(3)
    vocab = [f"w{i}" for i in range(60)]
    pool = [list(rng.choice(vocab, rng.integers(1, 30))) for _ in range(25)]
    rows = []
    for i in range(60):
        lines = []
        for _ in range(rng.integers(0, 6)):
            line = list(pool[rng.integers(0, len(pool))])
            for _ in range(rng.integers(0, 4)):
                line[rng.integers(0, len(line))] = str(rng.choice(vocab))
            lines.append(" ".join(line))
        rows.append((60 - i, "\n".join(lines)))
    rows += [(70, None), (71, ""), (72, "\n \n!\n!"), (73, "only here zzz")]
    gone, first = _line_brute(rows)
    # a set's fate is that of its first place: whatever matches an earlier set goes everywhere
    near = {s for (i, n, s) in _lines(rows) if any(first[o] < first[s] and 100 * len(s & o) >= 80 * len(s | o) for o in first)}
    want = {(i, n) for i, n, s in _lines(rows) if s in near or first[s] != (i, n)}
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], DOCS)
    got = {r.doc_id: r for r in linededup.dedup_lines(docs).collect()}
    assert {(i, n) for i, r in got.items() for n in r.removed} == want and len(want) > 30
    for i, t in rows:
        kept = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if (i, n) not in want)
        assert got[i].text == kept
        assert got[i].n_links == sum((i, n) in want and s in near for j, n, s in _lines(rows) if j == i)
    assert {i for i, t in rows if not (t or "").strip() or got[i].text.strip()} == {r.doc_id for r in linededup.rewrite(docs).collect()}
    assert linededup.rewrite(docs).columns == docs.columns


def test_line_dedup_edges(spark):
    assert linededup.dedup_lines(spark.createDataFrame([], DOCS)).count() == 0
    rows = [(None, "a b c", None, None, None), (1, "a b c", None, None, None), (1, "a b c", None, None, None), (2, "A b  c\nb c a\nx", None, None, None)]
    got = sorted((str(r.doc_id), r.text) for r in linededup.dedup_lines(spark.createDataFrame(rows, DOCS)).collect())
    assert got == [("1", "a b c"), ("1", "a b c"), ("2", "x"), ("None", "a b c")]


def test_line_links_match_brute_force(spark):
    rng = np.random.default_rng(8)
    hub = [f"w{i}" for i in range(12)]
    rows = [(9, " ".join(hub)), (3, " ".join([*hub, "x", "y"]) + "\n\n" + " ".join([*hub, "x", "y", "z", "q"])), (5, None), (6, "alone")]
    for i in range(20, 50):  # variants of one line: each has links besides that with the earliest
        rows.append((i, " ".join(w for j, w in enumerate(hub) if j != rng.integers(0, 12)) + f" v{i % 4}\n" + " ".join(hub[:11])))
    lines = _lines(rows)
    first = {}
    for i, n, s in lines:
        first.setdefault(s, (i, n))
    links = [(first[s], first[o]) for s in first for o in first if first[o] < first[s] and 100 * len(s & o) >= 80 * len(s | o)]
    degree = Counter(x for pair in links for x in pair)
    want = _components(first.values(), links)
    docs = spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows + rows[:1]], DOCS)
    got = {(r.doc_id, r.line): (r.n_links, r.class_doc, r.class_line) for r in linededup.line_links(docs).collect()}
    assert got == {(i, n): (degree[first[s]], *want[first[s]]) for i, n, s in lines}
    assert max(degree.values()) > 3 and got[3, 2][1:] == (3, 0)
    assert linededup.line_links(docs.filter("false")).count() == 0


def test_chunks_come_back_into_step():
    rng = np.random.default_rng(1)
    words = [f"v{i}" for i in rng.integers(0, 5000, 400)]
    text = lambda w: np.frombuffer(" ".join(w).encode(), np.uint8)
    a, b = text(words), text(["new", *words[:200], "other", *words[200:]])
    one, two = (set(chunkdedup.chunks(x, np.array([0, len(x)]))[-1].tolist()) for x in (a, b))
    assert len(one & two) >= len(one) - 6 and len(one) > 30


def test_repeated_passages_go_and_clean_texts_stay(spark):
    rng = np.random.default_rng(9)
    fresh = lambda n: " ".join(f"u{i}" for i in rng.integers(0, 10**9, n))
    passages = [fresh(51) for _ in range(40)]
    rows = [(i, f"{fresh(30)} {p} {fresh(30)}") for i, p in enumerate(passages)] + [(100 + i, f"{fresh(17)}\n{p}\n{fresh(40)}") for i, p in enumerate(passages)]
    rows += [(200 + i, fresh(90)) for i in range(20)] + [(300, None), (301, ""), (302, "same " * 500), (303, f"{passages[0]} x {passages[0]}")]
    got = {r.doc_id: r for r in chunkdedup.dedup_substrings(spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], DOCS)).collect()}
    for i in range(40):
        assert got[i].n_removed == 0 and got[i].n_repeated >= 20 and got[i].text == rows[i][1]
        assert got[100 + i].n_removed >= 20 and i in got[100 + i].first_ids
        lost = Counter(rows[40 + i][1].split()) - Counter(got[100 + i].text.split())
        assert not set(lost) - set(passages[i].split())
    assert all(got[200 + i].text == t and got[200 + i].n_repeated == 0 for i, (_, t) in enumerate(rows[80:100]))
    assert got[300].text is None and got[301].text == "" and got[302].n_removed > 0 and got[303].n_removed > 60


def test_substring_edges(spark):
    assert chunkdedup.dedup_substrings(spark.createDataFrame([], DOCS)).count() == 0
    t = " ".join(f"u{i * 7919}" for i in range(60))
    rows = spark.createDataFrame([(None, t, None, None, None), (1, t, None, None, None), (1, t, None, None, None)], DOCS)
    assert [r.n_removed for r in chunkdedup.dedup_substrings(rows).collect()] == [0, 0, 0]


def test_lines_are_read_in_small_slices(monkeypatch):
    import pyarrow as pa

    seen, whole = [], linededup.tx.spans
    monkeypatch.setattr(linededup.tx, "spans", lambda buf, *rest: seen.append(len(buf)) or whole(buf, *rest))
    batch = pa.RecordBatch.from_arrays([pa.array(["mot hai ba " * 20_000] * 16)], ["text"])  # 3.5 MB
    list(linededup._counted(iter([batch])))
    assert sum(seen) == 16 * 220_000 and max(seen) <= 1 << 20


def test_postings_travel_packed_and_lose_no_pair():
    import pyarrow as pa

    class Shared:
        value = np.full(1 << linededup.COUNTS, 20, np.uint8)

    rng = np.random.default_rng(4)
    vocab = [f"w{i}" for i in range(300)]
    pool = [list(rng.choice(vocab, rng.integers(1, 40))) for _ in range(40)]
    texts = []
    for _ in range(120):
        lines = [list(pool[k]) for k in rng.integers(0, len(pool), 5)]
        for line in lines:
            line[rng.integers(0, len(line))] = str(rng.choice(vocab))
        texts.append("\n".join(map(" ".join, lines)))
    ids = list(range(-60, 60))
    rng.shuffle(ids)
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids), pa.array(texts)], ["doc_id", "text_key", "text"])
    wide = list(linededup._keyed(Shared, 80, 100, 4)(iter([batch])))
    packed = [b.slice(k).select(["own", "tokens"]) for b in wide for k in [b["part"].null_count] if k < len(b)]
    (sets,) = linededup._distinct(iter(packed))
    first, many = {}, Counter()
    for i, n, s in _lines(zip(ids, texts, strict=True)):
        first.setdefault(s, (i, n))
        many[s] += 1
    place = {(r["doc_id"], r["line"]): r for r in sets.to_pylist()}
    assert {p: many[s] > 1 for s, p in first.items()} == {p: r["many"] for p, r in place.items()} and len(first) > 300
    bits = np.bitwise_xor.reduce([sets[c].to_numpy() for c in linededup._MAPS])
    assert (bits < 0).any()
    done = rng.random(len(sets)) < 0.3
    rows = pa.RecordBatch.from_arrays([sets["set_a"], sets["doc_id"], sets["size"], pa.array(bits), pa.array(done), sets["skip"], sets["prefix"]], ["set_a", "doc_id", "size", "bits", "done", "skip", "prefix"])
    posts = list(linededup._posted(4)(iter([rows])))
    assert sum(map(len, posts)) == 4  # a row for each part, not for each posting
    got = {(r["x"], r["y"]) for p in range(4) for b in linededup._paired(80, 100)(iter([pa.RecordBatch.from_arrays([b["content"].slice(p, 1)], ["content"]) for b in posts])) for r in b.to_pylist()}
    over = dict(zip(sets["set_a"].to_pylist(), done.tolist(), strict=True))
    want = {(place[first[s]]["set_a"], place[first[o]]["set_a"]) for s in first for o in first if first[o] < first[s] and 100 * len(s & o) >= 80 * len(s | o)}
    assert {(x, y) for x, y in want if not over[x]} <= got and len(want) > 100 and not any(over[x] for x, _ in got)


def test_word_hashes_tell_words_apart():
    words = [b"w" * n + tail for n in range(60) for tail in (b"a", b"b", b"\0", b"\0\0", "đ".encode())]
    ends = np.cumsum([len(w) for w in words])
    own, upper = (linededup._hashes(np.frombuffer(b"".join(x), np.uint8), np.append(0, ends[:-1]), ends) for x in (words, [w.upper() for w in words]))
    assert len(set(own.tolist())) == len(words) == len(set(words)) and (own == upper).all()


def test_only_wanted_lines_are_read_again():
    import pyarrow as pa

    class Shared:
        value = np.full(1 << linededup.COUNTS, 20, np.uint8)

    texts = ["", "a b\n\nc d e\n", "\n", "f\ng h\nf"] * 500
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)))] + [pa.array(texts)], ["doc_id", "text"])

    table = np.zeros((linededup.PIECES, (1 << linededup.WANTED - 5) // linededup.PIECES), np.uint32)
    wanted = pa.RecordBatch.from_arrays([pa.array([1, 3, 1999]), pa.array([2, 1, 2], pa.int32())], ["doc_id", "line"])
    for b in linededup._wanted(iter([wanted])):
        for r in b.to_pylist():
            table[r["piece"]] = linededup._open(r["content"])

    class Need:
        value = table.reshape(-1).view(np.uint8)

    got = [len(w) for b in linededup._words_of_wanted(Shared, Need)(iter([batch])) for w in b["words"].to_pylist()]
    assert sorted(got) == [1, 2, 3]
