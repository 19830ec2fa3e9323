"""URL and link predicates as native Column expressions."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Hosts that copy reports, the domain end that is trusted, and what marks a report's link and label.
PIRACY_HOSTS = ["tailieu.vn", "123doc.vn", "123doc.net", "123docz.net", "scribd.com", "slideshare.net", "academia.edu", "coursehero.com", "studocu.com", "text.123docz.net"]
TRUSTED_END = ".vn"
LINK = r"(?iu)(download.*id=\p{Nd}+|getfile|view_doc|.*\.pdf)"
LABEL = (
    r"(?iu)(bao\s*cao\s*thuong\s*nien|bctn|b[áa]o\s*c[áa]o\s*th[uư][ờo]ng\s*ni[êe]n|annual\s*report"
    r"|phat\s*trien\s*ben\s*vung|ph[áa]t\s*tri[êe]n\s*b[ềê]n\s*v[uư]ng|sustainability\s*report)"
)


def hostname(url: Column) -> Column:
    """The host in lower case, with or without a scheme, port or user, whatever characters the path or the host holds, without the brackets of a numeric one; null if there is none."""
    return F.nullif(F.translate(F.lower(F.regexp_extract(url, r"^(?:[^/?#]*?://)?(?:[^/?#]*@)?(\[[^/?#@\]]*\]|[^/?#@:\[]*)", 1)), "[]", ""), F.lit(""))


def under(host: Column, domain: Column) -> Column:
    """host is domain or lies under it."""
    return (host == domain) | F.endswith(host, F.concat(F.lit("."), domain))


def is_piracy(host: Column) -> Column:
    return F.exists(F.array(*map(F.lit, PIRACY_HOSTS)), lambda bad: under(host, bad))


def suffixes(host: Column) -> Column:
    """The host and all that it lies under, longest first: a.b.c, b.c, c."""
    parts = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))


def is_trusted(url: Column, official: Column) -> Column:
    """The issuer's own domain or a trusted end, but never a piracy host, whatever its end."""
    host = hostname(url)
    return F.coalesce(~is_piracy(host) & (under(host, F.lower(official)) | F.endswith(host, F.lit(TRUSTED_END))), F.lit(False))


def is_pdf(url: Column) -> Column:
    return F.contains(F.lower(url), F.lit(".pdf"))


def is_report_link(href: Column, label: Column, link: str = LINK, text: str = LABEL, strict: bool = True) -> Column:
    """Both the target and the label match; either, unless strict."""
    target, name = F.coalesce(href, F.lit("")).rlike(link), F.coalesce(label, F.lit("")).rlike(text)
    return target & name if strict else target | name


def resolve(base: Column, href: Column) -> Column:
    """href made absolute against base."""

    @F.pandas_udf("string")
    def join(bases: pd.Series, hrefs: pd.Series) -> pd.Series:
        return pd.Series([None if h is None else urljoin(b or "", h) for b, h in zip(bases, hrefs, strict=True)])

    return join(base, href)


class _Anchors(HTMLParser):
    """Targets and labels of the links of a page: each piece of text is stripped, and a link that isn't closed ends where the next begins."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str | None, list[str]]] = []
        self.open = False

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            target = dict(attrs).get("href")
            self.open = target is not None
            if self.open:
                self.found.append((target, []))

    def handle_endtag(self, tag):
        if tag == "a":
            self.open = False

    def handle_data(self, data):
        if self.open:
            self.found[-1][1].append(data.strip())


def _parsed(html: str) -> list[dict]:
    page = _Anchors()
    page.feed(html)
    page.close()
    return [{"href": h, "label": "".join(t)} for h, t in page.found]


def anchors(html: Column) -> Column:
    """(href, label) of the links in a page, in order, as a parser sees them: any quoting, entities resolved, labels without tags. Of a null, none."""

    @F.pandas_udf("array<struct<href:string,label:string>>")
    def parse(pages: pd.Series) -> pd.Series:
        return pd.Series([_parsed(p or "") for p in pages])

    return parse(html)
