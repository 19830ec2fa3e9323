"""Text functions as native Column expressions; NFC alone needs Arrow, as Spark has no such function.

Patterns spell out Unicode white space, use \\p{Nd} for digits and (?iu) for case, so that they mean what the same
patterns mean over Unicode strings elsewhere; (?d) leaves the line feed as the only line end.
"""

from __future__ import annotations

import os
import unicodedata
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
MAX_TOKENS = 200
DEFAULT_HEADING = "Thong tin chung"

# Digits that stand for letters in misread words, and words that lost a vowel.
LEET = ("013457", "oleast")
CONFUSABLES = {"cng": "cong"}
# What may open and close a word.
OPENING, CLOSING = "([{\"'“‘", ".,;:!?)]}\"'”’"
# Headings are I. to X., 1. to 99., 1.1 to 99.99. before white space; page footers start with these words.
HEADING = rf"(?diu)^((?:I{{1,3}}|IV|V|VI{{0,3}}|IX|X)\.|\p{{Nd}}{{1,2}}\.|\p{{Nd}}{{1,2}}\.\p{{Nd}}{{1,2}}\.?){WS}"
FOOTER = rf"(?dimu)^{WS}*(trang|page){WS}*\p{{Nd}}+.*$"
# Fixed value: a sentence ends at one of these before white space.
SENTENCE_END = rf"(?<=[.!?…]){WS}+"


def strip(x: Column) -> Column:
    return F.regexp_replace(x, f"^{WS}+|{WS}+$", "")


def tokens(x: Column) -> Column:
    """The words between white space."""
    return F.filter(F.split(x, f"{WS}+"), lambda w: w != "")


def count_tokens(x: Column) -> Column:
    return F.size(tokens(x))


def nfc(x: Column) -> Column:
    """Canonical composition; a null stays null."""

    @F.pandas_udf("string")
    def compose(s: pd.Series) -> pd.Series:
        return s.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))

    return compose(x)


def _folding() -> tuple[str, str]:
    """What translate() needs to drop diacritics: letters with their bases, then the combining marks, which go."""
    pairs, marks = [("đ", "d"), ("Đ", "D")], []
    for c in map(chr, [*range(0x80, 0x3100), *range(0xA66F, 0xAC00), *range(0xF900, 0xFFF0)]):
        if unicodedata.combining(c):
            marks.append(c)
            continue
        base = "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x))
        if len(base) == 1 and base != c:
            pairs.append((c, base))
    return "".join(a for a, _ in pairs) + "".join(marks), "".join(b for _, b in pairs)


#: Letters and their bases; the combining marks behind the last base go.
FOLDED = _folding()


def is_ascii(x: Column) -> Column:
    return F.length(x) == F.octet_length(x)


def fold(x: Column) -> Column:
    """Without diacritics; the d with stroke becomes d. Only words that aren't ASCII are looked up letter by letter."""
    word = lambda w: F.when(is_ascii(w), w).otherwise(F.translate(w, *FOLDED))
    return F.when(is_ascii(x), x).otherwise(F.array_join(F.transform(F.split(x, " ", -1), word), " "))


def normal(x: Column) -> Column:
    """Lower case without diacritics, as keywords are matched."""
    return fold(F.lower(x))


def deleet(token: Column) -> Column:
    """Letters for digits in words that mix them, unless all their letters are capitals (as in formulas)."""
    mixed = token.rlike(r"\p{L}") & token.rlike(r"\p{Nd}") & token.rlike(r"[\p{L}&&[^\p{Lu}]]")
    return F.when(mixed, F.translate(token, *LEET)).otherwise(token)


def _class(chars: str) -> str:
    return "[" + "".join("\\" + c if c in "[](){}.?'\"" else c for c in chars) + "]*"


def unconfuse(token: Column) -> Column:
    """A known misread word replaced, with its capital and the marks around it kept."""
    shape = f"(?s)^({_class(OPENING)})(.*?)({_class(CLOSING)})$"
    core = F.regexp_extract(token, shape, 2)
    right = F.element_at(F.create_map(*[F.lit(x) for kv in CONFUSABLES.items() for x in kv]), F.lower(core))
    cased = F.when(F.substring(core, 1, 1).rlike(r"\p{Lu}"), F.concat(F.upper(F.substring(right, 1, 1)), right.substr(F.lit(2), F.length(right)))).otherwise(right)
    return F.when(right.isNull(), token).otherwise(F.concat(F.regexp_extract(token, shape, 1), cased, F.regexp_extract(token, shape, 3)))


def repair_ocr(x: Column) -> Column:
    """deleet() and unconfuse() for each word between single spaces."""
    return F.array_join(F.transform(F.split(x, " ", -1), lambda t: unconfuse(deleet(t))), " ")


def paragraphs(x: Column) -> Column:
    """Text without page footers, single line feeds joined, split into stripped paragraphs that aren't empty. NFC first, where it matters."""
    joined = F.regexp_replace(F.regexp_replace(x, FOOTER, ""), r"(?<!\n)\n(?!\n)", " ")
    return F.filter(F.transform(F.split(joined, "\n", -1), strip), lambda p: p != "")


def is_heading(x: Column) -> Column:
    return x.rlike(HEADING)


def sentences(x: Column) -> Column:
    return F.filter(F.split(strip(x), SENTENCE_END, -1), lambda s: s != "")


def hard_split(x: Column, limit: int = MAX_TOKENS) -> Column:
    """(text, tokens) of each `limit` words."""

    def split(words):  # a lambda's variable: an expression in its place would split the whole text again for each piece
        n = F.ceil(F.size(words) / limit).cast("int")
        parts = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        return F.transform(parts, lambda i: F.struct(F.array_join(F.slice(words, i * limit + 1, F.lit(limit)), " ").alias("text"), F.least(F.lit(limit), F.size(words) - i * limit).alias("tokens")))

    return F.transform(F.array(tokens(x)), split)[0]


def content_hash(x: Column) -> Column:
    """SHA-256 of the text in lower case, composed, without white space; all blank texts are alike."""
    return F.sha2(F.regexp_replace(nfc(F.lower(x)), f"{WS}+", ""), 256)


def occurrences(x: Column, keyword: str) -> Column:
    """How often keyword (not empty) stands in x, without overlaps."""
    if not keyword:
        raise ValueError("an empty keyword")
    # Bytes, which needn't be counted, instead of characters.
    return ((F.octet_length(x) - F.octet_length(F.replace(x, F.lit(keyword), F.lit("")))) / len(keyword.encode())).cast("int")


def error_rate(read: Column, truth: Column) -> Column:
    """Edits over the length of the truth, both composed; for an empty truth 0, or 1 if something was read."""
    return F.transform(F.array(edits(read, truth)), lambda x: F.when(x.chars == 0, F.when(x.given == 0, 0.0).otherwise(1.0)).otherwise(x.edits / x.chars))[0]


def distance(a: str, b: str) -> int:
    """Levenshtein's distance; see distances()."""
    return distances([(a, b)])[0]


def distances(pairs: list[tuple[str, str]]) -> list[int]:
    """Levenshtein's distance of each pair, exactly.

    As many edits as letters of one text that the other lacks (counted with repeats) are needed at least, and as many
    as the pieces between passages that both have, each against its own, need are enough. Where the two differ, a band
    that holds every path of so many edits is looked at, then ones of twice as many, until what is found lies within.
    """
    out, held, pieces, size = [0] * len(pairs), [], [], 0
    for k, (a, b) in enumerate(pairs):
        lead = len(os.path.commonprefix([a, b]))
        tail = len(os.path.commonprefix([a[lead:][::-1], b[lead:][::-1]]))
        a, b = a[lead : len(a) - tail], b[lead : len(b) - tail]
        if len(a) < len(b):
            a, b = b, a
        if b:
            own = _pieces(a, b)
            held.append((k, a, b, len(own)))
            pieces += own
            size += len(a) + len(b)
        else:
            out[k] = len(a)
        if size > 1 << 20 or k == len(pairs) - 1:
            first, found = 0, _small(pieces)
            for i, x, y, n in held:
                out[i] = _settled(x, y, int(found[first : first + n].sum()) if n else len(x))
                first += n
            held, pieces, size = [], [], 0
    return out


#: Letters of a passage that two texts share (a shorter one where there is no longer one), and of the longest piece between two of them (the bits of a word).
_SHARED, _ROWS = (6, 4, 3, 2), 64


def _pieces(a: str, b: str) -> list[tuple[str, str]]:
    """Both texts cut where a passage of one stands once in the next letters of the other; none if there is no such passage somewhere."""
    out, i, j = [], 0, 0
    while len(a) - i > _ROWS:
        for size in _SHARED:
            for at in range(min(j + _ROWS - 8, len(b) - size), j + 7, -1):
                passage = b[at : at + size]
                p = a.find(passage, i + 1, i + _ROWS + size)
                if p > 0 and a.find(passage, p + 1, i + _ROWS + size) < 0:
                    break
            else:
                continue
            break
        else:
            return []
        out.append((a[i:p], b[j:at]))
        i, j = p, at
    return [*out, (a[i:], b[j:])] if len(b) - j <= 2 * _ROWS else []


def _small(pieces: list[tuple[str, str]]) -> np.ndarray:
    """The distance of each piece of at most _ROWS letters from its other, all side by side; as _whole()."""
    if not pieces:
        return np.zeros(0, np.int64)
    rows, columns = (np.array([len(p[k]) for p in pieces]) for k in (0, 1))
    order = np.argsort(-columns, kind="stable")
    texts = []
    for k, n, width, pad in ((0, rows, _ROWS, 0xFFFFFFFF), (1, columns, max(1, int(columns.max())), 0xFFFFFFFE)):
        codes = np.full((len(pieces), width), pad, np.uint32)
        codes[np.arange(width) < n[:, None]] = np.frombuffer("".join(p[k] for p in pieces).encode("utf-32-le", "surrogatepass"), np.uint32)
        texts.append(codes[order])
    own, other = texts
    one, total = np.uint64(1), rows[order].astype(np.int64)
    last = one << (rows[order] - 1).astype(np.uint64)
    up, down = np.full(len(pieces), ~np.uint64(0)), np.zeros(len(pieces), np.uint64)
    many = np.searchsorted(-columns[order], -np.arange(other.shape[1]), "left")  # that have the column
    for c, n in enumerate(many.tolist()):
        same = np.packbits(own[:n] == other[:n, c, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
        u, d = up[:n], down[:n]
        still = (((same & u) + u) ^ u) | same | d
        rise, fall = d | ~(still | u), u & still
        total[:n] += (rise & last[:n]) != 0
        total[:n] -= (fall & last[:n]) != 0
        rise = rise << one | one
        up[:n] = fall << one | ~(still | rise)
        down[:n] = rise & still
    out = np.empty(len(pieces), np.int64)
    out[order] = total
    return out


def _settled(a: str, b: str, enough: int) -> int:
    """The distance of a from b, which isn't longer; it is at most `enough`."""
    own, other = Counter(a), Counter(b)
    most = max(1, (own - other).total(), (other - own).total())
    if most == enough:
        return enough
    masks = _masks(a, own.keys() & other.keys())
    while 2 * most < len(a):
        found = _banded(masks, len(a), b, most)
        if found <= most:
            return found
        most = min(2 * most, enough)
    return _whole(masks, len(a), b)


def _masks(a: str, letters: set[str]) -> dict[str, int]:
    """Of each letter, an integer with a bit for each place where it stands."""
    if len(letters) <= 256:
        codes = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), np.uint32)
        return {c: int.from_bytes(np.packbits(codes == ord(c), bitorder="little").tobytes(), "little") for c in letters}
    places: dict[str, list[int]] = {}
    for i, c in enumerate(a):
        places.setdefault(c, []).append(i)
    masks = {}
    for c in letters:
        bits = bytearray(places[c][-1] // 8 + 1)
        for i in places[c]:
            bits[i >> 3] |= 1 << (i & 7)
        masks[c] = int.from_bytes(bits, "little")
    return masks


def _banded(masks: dict[str, int], n: int, b: str, most: int) -> int:
    """The distance of a text of n letters (its masks) from b, which isn't longer, if it is at most `most` (not less than the difference of their lengths); else a number above that. As _whole(), but the integers hold only the `most` + 1 diagonals that so few edits can reach, and move a row down with each column (Hyyrö)."""
    below, above = (most + n - len(b)) // 2, (most - n + len(b)) // 2
    width = below + above + 1
    full, bottom = (1 << width) - 1, width - 1
    up, down, total = full ^ ((1 << above) - 1), 0, below
    step, near, held = max(width, 256), {}, (1 << (width + max(width, 256))) - 1
    straight = n - below  # columns until the lowest diagonal meets the last row
    for j, c in enumerate(b):
        at = j % step
        if not at:  # masks of the next columns only, so that no whole one is shifted for each
            near, start = {}, j - above
        same = near.get(c)
        if same is None:
            whole = masks.get(c, 0)
            same = near[c] = (whole >> start if start >= 0 else whole << -start) & held
        same = same >> at & full
        still = (((same & up) + up) ^ up) & full | same | down
        rise = down | (full ^ (still | up))
        fall = still & up
        if j < straight:
            if not still >> bottom:
                total += 1
        else:
            row = bottom - 1 - (j - straight)
            total += (rise >> row & 1) - (fall >> row & 1)
        moved = still >> 1
        up = fall | (full ^ (moved | rise))
        down = moved & rise
    return total


def _whole(masks: dict[str, int], n: int, b: str) -> int:
    """The distance of a text of n letters from b, a column of the table at a time: two integers hold, with a bit for each letter of the first, where its values rise and fall by one from row to row (Myers; Hyyrö)."""
    full, last = (1 << n) - 1, 1 << (n - 1)
    up, down, total = full, 0, n
    for c in b:
        same = masks.get(c, 0)
        still = (((same & up) + up) ^ up) | same | down
        rise = down | (full & ~(still | up))
        fall = up & still
        if rise & last:
            total += 1
        elif fall & last:
            total -= 1
        rise = rise << 1 | 1
        up = (fall << 1 | ~(still | rise)) & full
        down = rise & still & full
    return total


def edits(read: Column, truth: Column) -> Column:
    """(edits, given, chars): the edits between two texts, both composed, and their lengths; null if either is. A text may be of any length: at worst the work is its product with the other's, 30 characters a step."""

    @F.pandas_udf("edits bigint, given bigint, chars bigint")
    def run(a: pd.Series, b: pd.Series) -> pd.DataFrame:
        nfc_ = [(None, None) if x is None or y is None else tuple(t if t.isascii() else unicodedata.normalize("NFC", t) for t in (x, y)) for x, y in zip(a, b, strict=True)]
        found = iter(distances([p for p in nfc_ if p[0] is not None]))
        out = [(None, None, None) if x is None else (next(found), len(x), len(y)) for x, y in nfc_]
        return pd.DataFrame(out, columns=["edits", "given", "chars"]).astype("Int64")

    return run(read, truth)
