import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import text as T
from tessera.operators import chunking


def test_clean_joins_lines_and_drops_footers(spark, one):
    raw = "Cau bi ngat\ndong giua.\n\nDoan hai.\nTrang 12 / 100"
    got = one(lambda x: T.paragraphs(T.nfc(F.col(x))), x=raw)
    assert got == ["Cau bi ngat dong giua.", "Doan hai."] == chunking.clean(raw)


@pytest.mark.parametrize("raw", ["", "\n\n", "Page\n\n12 x\ny", "a\r\nb\r\nc", " lead\n\n\ntail ", "Trang A", "x\ny\nz"])
def test_native_and_arrow_cleaning_agree(one, raw):
    assert one(lambda x: T.paragraphs(T.nfc(F.col(x))), x=raw) == chunking.clean(raw)


@pytest.mark.parametrize(("raw", "want"), [("N3t Zer0", "Net Zero"), ("Cng ty", "Cong ty"), ("phat thai CO2 nam 2023 la 1500 tan", "phat thai CO2 nam 2023 la 1500 tan"), ("m3 (cng), CNG!", "me (cong), Cong!"), ("", ""), ("a  b", "a  b")])
def test_ocr_repair(one, raw, want):
    assert one(lambda x: T.repair_ocr(F.col(x)), x=raw) == want


@pytest.mark.parametrize(("p", "want"), [("1. Tong quan", True), ("2.3 Co che du phong", True), ("III. Phan ket", True), ("Cong ty huong toi Net Zero.", False), ("1.5 trieu", True), ("2.3.1 x", False), ("XI. x", False), ("2023. x", False), ("1.", False)])
def test_headings(one, p, want):
    assert one(lambda x: T.is_heading(F.col(x)), x=p) is want
    assert bool(chunking._HEADING.match(p)) is want


def test_chunks_stay_within_the_limit():
    got = list(chunking.chunks(["1. Moi truong", *(f"Cau so {i} ve phat thai." for i in range(60))]))
    assert got[0][0] == "1. Moi truong" and all(n <= 200 for *_, n in got) and len(got) > 1
    giant = " ".join(f"Cau so {i} ve phat thai khi nha kinh." for i in range(200))
    assert len(got := list(chunking.chunks([giant]))) > 1 and all(n <= 200 for *_, n in got)
    run_on = list(chunking.chunks([" ".join(["phatthai"] * 500)]))
    assert [n for *_, n in run_on] == [200, 200, 100]


def test_last_piece_of_a_long_paragraph_keeps_packing():
    long = " ".join(f"Mot hai ba bon nam {i}." for i in range(40))
    got = list(chunking.chunks([long, "ngan"], "h"))
    assert got[-1][1].endswith("ngan") and sum(n for *_, n in got) == 241


def test_arrow_and_native_packing_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    short = docs.select("doc_id", F.filter(F.transform(T.sentences(F.col("text")), lambda s: F.struct(s.alias("text"), T.count_tokens(s).alias("n"))), lambda p: p.n <= 200).alias("parts"))
    native = {r.doc_id: [tuple(p) for p in r.p] for r in short.select("doc_id", chunking.pack_native(F.col("parts")).alias("p")).collect()}
    for r in short.collect():
        assert native[r.doc_id] == list(chunking._packed([p.text for p in r.parts], 200, chunking.words_of))


def test_hard_split(one):
    got = one(lambda x: T.hard_split(F.col(x), 2), x="a b c\td  e")
    assert [tuple(g) for g in got] == [("a b", 2), ("c d", 2), ("e", 1)]
    assert one(lambda x: T.hard_split(F.col(x), 2), x=" ") == []


def test_hard_split_reads_a_text_once(spark):
    rows = spark.createDataFrame([("a b c",), (None,)], "x string")
    out = rows.select(T.hard_split(F.col("x"), 2).alias("p"))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
    assert [[tuple(p) for p in r.p] for r in out.collect()] == [[("a b", 2), ("c", 1)], []]


def test_pieces_of_a_batch_are_made_a_slice_at_a_time():
    import tracemalloc

    import pyarrow as pa

    texts = pa.array([None, "", *(f"{'Mot hai ba bon nam. ' * 500}{i}" for i in range(3000))])  # 30 MB
    tracemalloc.start()
    got = chunking._listed(texts, chunking._PIECE, lambda _, x: chunking.split_to_limit(x, 200, chunking.words_of))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 25 << 20  # the pieces of all texts take 30 MB
    assert got[0].as_py() == got[1].as_py() == []
    for i in (2, 1500, 3001):
        assert [(p["text"], p["token_count"]) for p in got[i].as_py()] == chunking.split_to_limit(texts[i].as_py())


def test_content_hash_ignores_composition_case_and_space(one):
    a, b = unicodedata.normalize("NFC", "Phát thải khí nhà kính"), unicodedata.normalize("NFD", " phát THẢI khí nhà\nkính ")
    assert a != b and one(lambda x: T.content_hash(F.col(x)), x=a) == one(lambda x: T.content_hash(F.col(x)), x=b)


def test_fold_and_counts(one):
    assert one(lambda x: T.normal(F.col(x)), x="Đường ĐẠI học é") == "duong dai hoc e"
    assert one(lambda x: T.count_tokens(F.col(x)), x=" a b　c\x1cd ") == 4
    assert one(lambda x: T.occurrences(F.col(x), "aa"), x="aaaaa") == 2
    with pytest.raises(ValueError):
        T.occurrences(F.lit("x"), "")


def test_sentences(one):
    assert one(lambda x: T.sentences(F.col(x)), x=" Co 1.500 tan. Hai!  Ba… bon ") == ["Co 1.500 tan.", "Hai!", "Ba…", "bon"]


def test_edit_distance_by_bounds_bands_and_whole_tables():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    rng, pairs = np.random.default_rng(5), [("", ""), ("abc", ""), ("listen", "silent"), ("ab" * 200, "ba" * 200), ("a" * 300, "b" * 200), ("é" * 90, "e" * 80)]
    for _ in range(60):
        a = "".join(rng.choice(list("abcdefghij klmno"[: int(rng.integers(1, 17))]), int(rng.integers(0, 400))))
        b = list(a)
        for i in sorted(rng.integers(0, len(a) + 1, int(rng.integers(0, 1 + len(a) // 4))).tolist(), reverse=True):
            b[i : i + int(rng.integers(0, 3))] = "".join(rng.choice(list("abé"), int(rng.integers(0, 2))))
        pairs += [(a, "".join(b)), ("".join(b), a)]
    assert T.distances(pairs) == [plain(a, b) for a, b in pairs]
    # A garbled text is settled by its pieces alone, without a table of the whole.
    truth = "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), 400_000))
    read = truth.replace("th", "").translate({ord("o"): 1, ord("e"): 2})
    assert T.distance(read, truth) == len(truth) - len(truth.replace("th", "").translate({ord("o"): None, ord("e"): None}))
