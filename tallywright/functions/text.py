"""Column functions on text. All are built-in expressions, so plans stay inside code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Space, tab, line feed, carriage return, ideographic space.
BLANKS = " \t\n\r\u3000"
#: What a literal of that list strips where backslashes stay as they are: space, backslash, t, n, r, ideographic space.
BLANKS_AS_TYPED = " \\tnr\u3000"
UNIT_SEPARATOR = "\x1f"


def trim_cell(cell: Column, as_typed: bool = False) -> Column:
    return F.btrim(cell, F.lit(BLANKS_AS_TYPED if as_typed else BLANKS))


def code_of(cell: Column, digits: int = 2) -> Column:
    """The leading digits, '' if there are fewer."""
    return F.regexp_extract(cell, rf"^([0-9]{{{digits}}})", 1)


def label_of(cell: Column, digits: int = 2) -> Column:
    return F.regexp_replace(cell, rf"^[0-9]{{{digits}}}", "")


def is_code(code: Column, digits: int = 2) -> Column:
    """Exactly so many ASCII digits; a line end after them doesn't pass."""
    return code.rlike(rf"^[0-9]{{{digits}}}\z")


def digest_id(parts: list[Column], tail: list[Column], length: int = 16) -> Column:
    """``parts`` joined by ':' and the start of the SHA-256 of parts and tail joined by the unit separator; null if any is."""

    def join(columns: list[Column], by: str) -> Column:
        return reduce(lambda a, b: F.concat(a, F.lit(by), b), [c.cast("string") for c in columns])

    return F.concat(join(parts, ":"), F.lit(":"), F.substring(F.sha2(join(parts + tail, UNIT_SEPARATOR), 256), 1, length))


def in_list(value: Column, listed: Column) -> Column:
    """Whether ``value`` is one of the '|'-separated values."""
    return F.array_contains(F.split(listed, "[|]"), value)


def like_within(value: Column, part: Column) -> Column:
    """value LIKE '%part%'; wildcards within ``part`` count, as they do in SQL."""
    return F.like(value, F.concat(F.lit("%"), part, F.lit("%")))


def differs(a: Column, b: Column) -> Column:
    """Unequal, or missing on either side (the sentinel comparison: a missing value never equals anything)."""
    return a.isNull() | b.isNull() | (a != b)


def column_name(name: Column) -> Column:
    """A header without its number prefix and bracketed units."""
    bare = F.regexp_replace(name, "^[0-9０-９]+[._\\-\\s]*", "")
    return F.trim(F.regexp_replace(bare, "[（(].*?[）)]", ""))


def direction_of(title: Column) -> Column:
    """expenditure or revenue by the one of the two words in the title, else unknown."""
    spent, got = title.contains("歳出"), title.contains("歳入")
    return F.when(spent & ~got, "expenditure").when(got & ~spent, "revenue").otherwise("unknown")


def fullwidth_digits(value: int) -> str:
    return str(value).translate(str.maketrans("0123456789", "０１２３４５６７８９"))


# Eras and the years that they began in, the latest first.
ERAS = (("令和", 2019), ("平成", 1989), ("昭和", 1926))


def era_labels(year: int) -> list[str]:
    """Ways to write a fiscal year in its era, with either kind of digits; an era's first year has a sign of its own."""
    era, first = next(((e, y) for e, y in ERAS if y <= year), (None, 0))
    if era is None:
        raise ValueError(f"no era is declared for {year}")
    n = year - first + 1
    return [f"{era}{x}年度" for x in (["元"] if n == 1 else [str(n), fullwidth_digits(n)])]


def has_era_label(text: Column, year: int) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(x) for x in era_labels(year)])


def is_whole_number(text: Column) -> Column:
    return text.rlike(r"^-?[0-9]+\z")


def yen_short(amount: Column) -> Column:
    """Compact amounts: in 億円 from a hundred million (whole ones from ten thousand million), in 万円 from ten thousand, else in 円."""
    size = F.abs(amount)
    return (
        F.when(size >= 10_000_000_000, F.concat(F.format_string("%.0f", F.round(amount / 100_000_000).cast("double")), F.lit("億円")))
        .when(size >= 100_000_000, F.concat(F.format_string("%.1f", F.round(amount / 100_000_000, 1).cast("double")), F.lit("億円")))
        .when(size >= 10_000, F.concat(F.format_number(F.round(amount / 10_000), 0), F.lit("万円")))
        .otherwise(F.concat(F.format_number(amount, 0), F.lit("円")))
    )


def any_contains(columns: list[Column], text: str) -> Column:
    """Case-insensitive substring search over several columns; '' finds all."""
    wanted = F.lit(text.lower())
    return reduce(lambda a, b: a | b, [F.coalesce(F.contains(F.lower(c), wanted), F.lit(False)) for c in columns])


def labelled(code: Column, names: dict[str, str]) -> Column:
    """The name of a code by a small constant map, '' for unknown codes."""
    pairs = [x for k, v in names.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.element_at(F.create_map(*pairs), code), F.lit(""))


def sniff(content: Column) -> Column:
    """zip, pdf, xls, html or text, by the first 200 bytes."""
    head = F.hex(F.substring(content, 1, 4))
    return F.when(head.startswith("504B"), "zip").when(head == "25504446", "pdf").when(head.startswith("D0CF"), "xls").when(is_html(content), "html").otherwise("text")


def is_html(content: Column) -> Column:
    """Whether bytes begin with a document type or an html element, after blanks; what a server sends that hasn't the file."""
    return F.decode(F.substring(content, 1, 200), "ISO-8859-1").rlike(r"(?i)^\s*<(!DOCTYPE|html)")


def origin_of(url: Column) -> Column:
    """Scheme and authority."""
    return F.concat(F.parse_url(url, F.lit("PROTOCOL")), F.lit("://"), F.parse_url(url, F.lit("AUTHORITY")))


def any_within(text: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(w) for w in words])


def data_rows(text: Column) -> Column:
    """Non-blank lines less the header, at least 0."""
    lines = F.filter(F.split(text, "\r?\n"), lambda line: F.trim(line) != "")
    return F.greatest(F.size(lines) - 1, F.lit(0))
