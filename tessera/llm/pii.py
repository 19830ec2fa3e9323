"""Personal data: base patterns, and bootstrapped contextual extraction of more.

Base spans seed the bootstrap. Every mention (a base span, or any other stretch of words with a digit or an at sign)
has an instance (its characters) and lexical patterns (two words to the left; the word to the left, or to the right,
with the mention's shape). Spark scores the graph of patterns and instances in rounds: a pattern's confidence in a kind
is the summed confidence of its instances of that kind over all its instances; instances that confident patterns agree
on join the kind for good, and count from the next round on, until a round adds none. Mentions of joined instances are
added to the base spans.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm import _text as tx
from tessera.llm._spark import cut

KINDS = ("email", "ip", "card", "phone")
#: Least confidence of a pattern and of a new instance, least number of known instances that support a pattern.
PATTERN, INSTANCE, SUPPORT = 0.8, 0.9, 3

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
#: Only the first digit of a run can start an address: a later one would meet the same end.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"\S+")
_DIGITS = re.compile(r"[0-9]")
_TRIM = ".,;:!?\"'()[]{}<>=|"


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def _emails(text: str):
    """From each at sign, the longest local part to its left (not before the last match's end), then the domain."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def base(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind) of the base spans, by start, then kind."""
    out = [(s, e, 0) for s, e in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((m.start(), m.end(), 1))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), m.end(), 2))
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGITS.findall(m[0])) <= 15:
            out.append((m.start(), m.end(), 3))
    return sorted(out, key=lambda x: (x[0], x[2]))


def _shape(s: str) -> str:
    """Letters as a, digits as 9; runs of letters count once, runs of digits up to 20."""
    return re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]{21,}", "9" * 20, re.sub(r"[0-9]", "9", s)))


def _code(*parts) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(parts)) - (1 << 63)


def mentions(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
    """The base spans and the other stretches with digits or at signs, each with its instance and patterns."""
    words = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    starts = [s for s, _ in words]
    taken = [(s, e) for s, e, _ in spans]
    found = [(s, e, k) for s, e, k in spans]
    run = None
    for s, e in [*words, (len(text) + 2, len(text) + 2)]:
        marked = any(c.isdigit() or c == "@" for c in text[s:e])
        if run and marked and s == run[1] + 1 and text[run[1]] == " ":
            run = run[0], e
            continue
        if run:
            a, b = run
            while a < b and text[a] in _TRIM:
                a += 1
            while b > a and text[b - 1] in _TRIM:
                b -= 1
            if a < b and not any(x < b and a < y for x, y in taken):
                found.append((a, b, -1))
        run = (s, e) if marked else None
    out = []
    for s, e, k in found:
        i, j = int(np.searchsorted(starts, s, "right")), int(np.searchsorted(starts, e, "left"))
        inner = text[starts[i - 1] : s] if i and starts[i - 1] < s < words[i - 1][1] else ""  # what stands before it in its own word
        before = i - 1 if i and words[i - 1][1] > s else i
        left = [text[x:y].lower() for x, y in words[max(0, before - 2) : before]] + ([inner.lower()] if inner else [])
        right = text[slice(*words[j])].lower() if j < len(words) else ""
        shape = _shape(text[s:e])
        pats = [_code("l2", *left[-2:])] if len(left) > 1 else []
        pats += [_code("ls", left[-1], shape)] if left else []
        pats += [_code("rs", right, shape)] if right else []
        out.append({"s": s, "e": e, "kind": k, "inst": _code("i", text[s:e].lower()), "pats": pats})
    return out


_MENTIONS = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64()), ("kind", pa.int32()), ("inst", pa.int64()), ("pats", pa.list_(pa.int64()))]))
_SIGNS = np.zeros(256, bool)
_SIGNS[48:58] = _SIGNS[64] = True


@tx.released
def _found(batches):
    for batch in batches:
        for lo, hi, buf, offs in tx.slices(batch.column(2)):
            marked = np.concatenate(([0], np.cumsum(_SIGNS[buf])))
            some = np.diff(marked[offs]) > 0
            rows, own = [], []
            for i in range(hi - lo):
                spans = []
                if some[i]:
                    text = buf[offs[i] : offs[i + 1]].tobytes().decode()
                    spans = base(text)
                    own.append(mentions(text, spans))
                else:
                    own.append([])
                counts = [0, 0, 0, 0]
                for *_, k in spans:
                    counts[k] += 1
                rows.append((*counts, ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in spans)))
            cols = list(zip(*rows, strict=True))
            digest = pa.array([hashlib.sha256(x.encode()).hexdigest() for x in cols[4]])
            yield pa.RecordBatch.from_arrays([*(batch.column(c).slice(lo, hi - lo) for c in (0, 1)), *(pa.array(c, pa.int64()) for c in cols[:4]), digest, pa.array(cols[4]), pa.array(own, _MENTIONS)], ["doc_id", "row", *(f"n_{k}" for k in KINDS), "base_sha256", "base", "mentions"])


def bootstrap(graph: DataFrame) -> DataFrame:
    """(inst, kind) of the instances that the rounds add; graph: distinct (inst, kind or -1, pat).

    An instance that joined stays, so every round but the last adds one at least and the rounds end. An empty graph adds
    none. Of kinds that are as likely, the first counts.
    """
    known = cut(graph.filter("kind >= 0").groupBy("inst", "kind").agg(F.lit(1.0).alias("conf")))
    links = cut(graph.select("inst", "pat").distinct())
    size = links.groupBy("pat").agg(F.count("*").alias("n")).withColumnRenamed("pat", "of")
    added = known.select("inst", "kind").filter("false")
    while True:
        score = links.join(known, "inst").groupBy("pat", "kind").agg(F.sum("conf").alias("sum"), F.count("*").alias("support")).filter(F.col("support") >= SUPPORT)
        score = score.join(size, F.col("pat") == F.col("of")).withColumn("trust", F.col("sum") / (F.col("n") + 0.5)).filter(F.col("trust") >= PATTERN).select("pat", "kind", "trust")
        new = links.join(known.select("inst").distinct(), "inst", "left_anti").join(score, "pat").groupBy("inst", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.least("trust", F.lit(0.999)))))).alias("conf")).filter(F.col("conf") >= INSTANCE)
        new = new.groupBy("inst").agg(F.max(F.struct("conf", (-F.col("kind")).alias("first"))).alias("best"))
        new = cut(new.select("inst", (-F.col("best.first")).alias("kind"), F.col("best.conf").alias("conf")))
        if new.isEmpty():
            return added
        known, added = cut(known.unionByName(new)), cut(added.unionByName(new.select("inst", "kind")))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of docs: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans.

    spans lists the base spans and those the bootstrap adds, as kind:start:end in code points, by start, then kind. A
    null or empty text has none; null and repeated ids are rows like any other; other columns are ignored. Documents
    with neither digits nor at signs are passed over after one look at their bytes.
    """
    docs = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = cut(docs.mapInArrow(_found, f"doc_id {kind}, row long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, base string, mentions array<struct<s:long,e:long,kind:int,inst:long,pats:array<long>>>"))
    each = rows.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    added = bootstrap(each.select("inst", "kind", F.explode("pats").alias("pat")).distinct())
    more = each.filter("kind < 0").select("row", "s", "e", "inst").join(added, "inst").groupBy("row").agg(F.collect_set(F.struct("s", "kind", "e")).alias("more")).withColumnRenamed("row", "of")
    base_ = F.expr("transform(filter(mentions, m -> m.kind >= 0), m -> named_struct('s', m.s, 'kind', m.kind, 'e', m.e))")
    out = rows.join(more, F.col("row") == F.col("of"), "left")
    all_ = F.array_sort(F.concat(base_, F.coalesce("more", F.expr("cast(array() as array<struct<s:long,kind:int,e:long>>)"))))
    names = F.array(*map(F.lit, KINDS))
    text = F.array_join(F.transform(all_, lambda m: F.concat_ws(":", F.element_at(names, m.kind + 1), m.s.cast("string"), m.e.cast("string"))), ",")
    return out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", text.alias("spans"))
