"""DuckDB SQL of the text functions, for the oracles of the queries."""

from __future__ import annotations

from tessera.operators.taxonomy import ORDER, THRESHOLD, Keyword

_WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def tokens(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '{_WS}+'), lambda w: w <> '')"


def count(x: str) -> str:
    return f"len({tokens(x)})"


def normal(x: str) -> str:
    return f"replace(strip_accents(lower({x})), 'đ', 'd')"


def sentences(x: str) -> str:
    """No lookbehind here: a unit separator is put at each sentence end instead."""
    return f"list_filter(string_split(regexp_replace({strip(x)}, '([.!?…]){_WS}+', '\\1' || chr(31), 'g'), chr(31)), lambda s: s <> '')"


def paragraphs(x: str) -> str:
    footed = f"regexp_replace(nfc_normalize({x}), '(?im)^{_WS}*(trang|page){_WS}*\\p{{Nd}}+.*$', '', 'g')"
    once = lambda t: f"regexp_replace({t}, '([^\\n])\\n([^\\n])', '\\1 \\2', 'g')"
    joined = f"replace({once(once(f'chr(2) || {footed} || chr(2)'))}, chr(2), '')"
    return f"list_filter(list_transform(string_split({joined}, chr(10)), lambda p: {strip('p')}), lambda p: p <> '')"


def score(n: str, words: list[Keyword], category: str) -> str:
    return " + ".join(f"((length({n}) - length(replace({n}, '{w.keyword}', ''))) // {len(w.keyword)}) * {w.weight}" for w in words if w.category == category)


def tags(n: str, words: list[Keyword], threshold: int = THRESHOLD) -> str:
    rank = lambda c: ORDER.index(c[0]) if c[0] in ORDER else len(ORDER)
    cats = sorted(dict.fromkeys(w.category for w in words), key=rank)
    return f"array_to_string(list_filter([{', '.join(f"CASE WHEN {score(n, words, c)} >= {threshold} THEN '{c}' END" for c in cats)}], lambda x: x IS NOT NULL), ',')"


_PIECE = "STRUCT(k INT, t VARCHAR, n BIGINT)"


def _fold(units: str, start_extra: str = "") -> str:
    """Greedy packing of units {k, t, n}: k 0 joins while it fits, 1 is closed at once, 2 closes what was and stays open."""
    state = "{{'k': 0, 't': {t}, 'n': {n}, 'out': {out}}}"
    flush = "CASE WHEN a.t = '' THEN a.out ELSE list_append(a.out, {'k': 0, 't': a.t, 'n': a.n}) END"
    return f"""list_reduce({units}, lambda a, e: CASE
 WHEN e.k = 1 THEN {state.format(t="''", n="0::BIGINT", out=f"list_append({flush}, {{'k': 0, 't': e.t, 'n': e.n}})")}
 WHEN e.k = 2 OR (a.t <> '' AND a.n + e.n > 200) THEN {state.format(t="e.t", n="e.n", out=flush)}
 ELSE {state.format(t="CASE WHEN a.t = '' THEN e.t ELSE a.t || ' ' || e.t END", n="a.n + e.n", out="a.out")} END,
 {state.format(t="''", n="0::BIGINT", out=f"[]::{_PIECE}[]")})"""


def pieces(src: str) -> str:
    """CTEs from src (id, pos, p): pieces (id, pos, k, t, n), each paragraph split to the limit."""
    return f"""
sents AS (SELECT id, pos, unnest(ss) AS s, generate_subscripts(ss, 1) AS i FROM (SELECT id, pos, {sentences('p')} AS ss FROM {src})),
parts AS (SELECT id, pos, i, s, {tokens('s')} AS ws FROM sents),
units AS (SELECT id, pos, i, 0 AS j, 0 AS k, s AS t, len(ws)::BIGINT AS n FROM parts WHERE len(ws) <= 200
 UNION ALL SELECT id, pos, i, j, 1, array_to_string(ws[j * 200 + 1 : j * 200 + 200], ' '), least(200, len(ws) - j * 200)::BIGINT FROM (SELECT *, unnest(range(0, (len(ws) + 199) // 200)) AS j FROM parts WHERE len(ws) > 200)),
folded AS (SELECT id, pos, {_fold('us')} AS r FROM (SELECT id, pos, list({{'k': k, 't': t, 'n': n, 'out': []::{_PIECE}[]}} ORDER BY i, j) AS us FROM units GROUP BY id, pos)),
done AS (SELECT id, pos, CASE WHEN r.t = '' THEN r.out ELSE list_append(r.out, {{'k': 0, 't': r.t, 'n': r.n}}) END AS ps FROM folded),
pieces AS (SELECT id, pos, unnest(ps).t AS t, unnest(ps).n AS n, generate_subscripts(ps, 1) AS k, len(ps) AS of FROM done)"""


def chunks(docs: str) -> str:
    """CTEs from a query (id, ticker, fiscal_year, raw): chunked (those, pos, h, t, n)."""
    heading = r"'^([0-9]{1,2}[.]|[0-9]{1,2}[.][0-9]{1,2}[.]?|(?i:I{1,3}|IV|V|VI{0,3}|IX|X)[.])\s'"
    return f"""WITH docs AS ({docs}),
paras AS (SELECT id, unnest(ps) AS p, generate_subscripts(ps, 1) AS pos FROM (SELECT id, {paragraphs('raw')} AS ps FROM docs)),
headed AS (SELECT *, regexp_matches(p, {heading}) AS is_h, {count('p')}::BIGINT AS n FROM paras),
ruled AS (SELECT *, count(*) FILTER (WHERE is_h) OVER (PARTITION BY id ORDER BY pos) AS sect, coalesce(last_value(CASE WHEN is_h THEN p END IGNORE NULLS) OVER (PARTITION BY id ORDER BY pos ROWS UNBOUNDED PRECEDING), 'Thong tin chung') AS h FROM headed),
long AS (SELECT id, pos, p FROM ruled WHERE NOT is_h AND n > 200), {pieces('long')},
parts2 AS (SELECT id, sect, h, pos, 0 AS j, 0 AS k, p AS t, n FROM ruled WHERE NOT is_h AND n <= 200
 UNION ALL SELECT r.id, r.sect, r.h, r.pos, q.k, CASE WHEN q.k = q.of THEN 2 ELSE 1 END, q.t, q.n FROM pieces q JOIN ruled r ON q.id = r.id AND q.pos = r.pos),
folded2 AS (SELECT id, sect, h, {_fold('us')} AS r FROM (SELECT id, sect, h, list({{'k': k, 't': t, 'n': n, 'out': []::{_PIECE}[]}} ORDER BY pos, j) AS us FROM parts2 GROUP BY id, sect, h)),
done2 AS (SELECT id, sect, h, CASE WHEN r.t = '' THEN r.out ELSE list_append(r.out, {{'k': 0, 't': r.t, 'n': r.n}}) END AS ps FROM folded2),
flat AS (SELECT id, sect, h, unnest(ps).t AS t, unnest(ps).n AS n, generate_subscripts(ps, 1) AS k FROM done2),
chunked AS (SELECT docs.id, ticker, fiscal_year, row_number() OVER (PARTITION BY docs.id ORDER BY sect, k) AS pos, h, t, n FROM flat JOIN docs ON flat.id = docs.id)
"""
