"""Links of stored directory pages."""

from __future__ import annotations

from html import entities

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Text a browser does not read as markup.
NOT_MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"

_VALUE = r"""(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
_ATTRIBUTE = r"""\s+[^\s"'>/=]+(?:\s*=\s*""" + _VALUE + ")?"

# An anchor's attributes are stepped over one by one up to ``href``, so neither
# ``data-href`` nor text inside another value is taken for it.
ANCHOR_HREF = r"(?is)<a(?:" + _ATTRIBUTE + r")*?\s+href\s*=\s*(" + _VALUE[3:-1] + ")"

# A character reference by number or by name.
REFERENCE = r"&#[xX][0-9a-fA-F]{1,6};?|&#[0-9]{1,7};?|&[A-Za-z][A-Za-z0-9]*;"
# The names of HTML 4, as Python's own table has them, and the apostrophe.
NAMED = {**entities.name2codepoint, "apos": 39}


def _character(reference: Column) -> Column:
    """What a reference stands for; itself if that is unknown."""
    body = F.rtrim(F.substring(reference, F.lit(2), F.length(reference)), F.lit(";"))
    digits = F.regexp_replace(body, "^#[xX]?", "")
    number = F.when(body.rlike("^#[xX]"), F.conv(digits, 16, 10)).when(body.startswith("#"), digits).cast("int")
    number = F.coalesce(number, F.element_at(F.create_map(*[F.lit(x) for kv in NAMED.items() for x in kv]), body))
    valid = (number > 0) & (number <= 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    text = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    return F.when(valid, text).otherwise(reference)


def resolved(text: Column) -> Column:
    """Text with its character references resolved, each once."""
    parts = F.split(text, f"(?={REFERENCE})")

    def part(p: Column) -> Column:
        found = F.regexp_extract(p, f"^(?:{REFERENCE})", 0)
        return F.when(found == "", p).otherwise(F.concat(_character(found), F.substring(p, F.length(found) + 1, F.length(p))))

    return F.when(text.contains("&"), F.array_join(F.transform(parts, part), "")).otherwise(text)


def hrefs(html: Column) -> Column:
    """Distinct ``href`` values of a page's anchors.

    Empty values and links to the parent folder are left out; a NULL page (a
    failed fetch) has none.
    """
    found = F.regexp_extract_all(F.regexp_replace(html, NOT_MARKUP, ""), F.lit(ANCHOR_HREF), F.lit(1))

    def value(raw: Column) -> Column:
        quoted = raw.startswith('"') | raw.startswith("'")
        text = F.when(quoted, F.substring(raw, F.lit(2), F.length(raw) - 2)).otherwise(raw)
        return resolved(text)

    kept = F.filter(F.transform(found, value), lambda h: (h != "") & ~h.startswith("../"))
    return F.array_distinct(kept)


def page_links(pages: DataFrame, keys: list[str], html: str = "html", pages_unique: bool = True) -> DataFrame:
    """One row per page and link.

    With one row per page the set is taken inside the row and nothing is
    shuffled; ``pages_unique=False`` also merges copies of a page.
    """
    links = pages.select(*keys, F.explode(hrefs(F.col(html))).alias("href"))
    return links if pages_unique else links.distinct()
