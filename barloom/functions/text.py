"""Text and number normalisation, and extraction from pages, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented Vietnamese and Latin letters, grouped by plain letter.
ACCENTS = {
    "a": "àáâãäåăạảấầẩẫậắằẳẵặ",
    "c": "ç",
    "d": "đ",
    "e": "èéêëẹẻẽếềểễệ",
    "i": "ìíîïịỉĩ",
    "n": "ñ",
    "o": "òóôõöơọỏốồổỗộớờởỡợ",
    "u": "ùúûüưụủũứừửữự",
    "y": "ýÿỳỵỷỹ",
}
ACCENTED = "".join(ACCENTS.values())
PLAIN = "".join(k * len(v) for k, v in ACCENTS.items())


def plain_label(x: Column) -> Column:
    """Lower case, accents stripped, every other run of characters one space."""
    bare = F.translate(F.lower(F.trim(x)), ACCENTED, PLAIN)
    return F.trim(F.regexp_replace(bare, "[^a-z0-9]+", " "))


def parse_number(x: Column) -> Column:
    """Number of a statement cell: ``(x)`` is negative, percent and spaces go, comma or point rules."""
    text = F.regexp_replace(F.regexp_replace(F.trim(x), "−", "-"), "[% ]", "")
    text = F.regexp_replace(text, r"^\((.*)\)$", "-$1")
    decimal_comma = (F.length(F.regexp_replace(text, "[^,]", "")) == 1) & ~F.contains(text, F.lit("."))
    text = F.when(decimal_comma, F.regexp_replace(text, ",", ".")).otherwise(F.regexp_replace(text, ",", ""))
    return text.try_cast("double")


def parse_period_end(label: Column, span: Column) -> Column:
    """Period end from a ``... dd/MM/yyyy`` range, else from a ``Qn/yyyy`` label."""
    written = F.try_to_date(F.nullif(F.regexp_extract(span, r"(\d{2}/\d{2}/\d{4})$", 1), F.lit("")), "dd/MM/yyyy")
    quarter = F.regexp_extract(label, r"^\s*Q([1-4])/(\d{4})", 1).try_cast("int")
    year = F.regexp_extract(label, r"^\s*Q([1-4])/(\d{4})", 2).try_cast("int")
    return F.coalesce(written, F.last_day(F.make_date(year, quarter * 3, F.lit(1))))


def safe_double(x: Column) -> Column:
    """Double of any text or number; blanks, NaN and infinities are null."""
    value = x.cast("string").try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def round_or_null(x: Column, digits: int) -> Column:
    """Half-even rounding of a safe double."""
    return F.bround(safe_double(x), digits)


def yes_no(x: Column) -> Column:
    """YES for a true-like value, NO otherwise (null included)."""
    return F.when(F.lower(x.cast("string")).isin("true", "1", "yes", "1.0"), "YES").otherwise("NO")


def attribute_symbols(html: Column, pattern: str) -> Column:
    """Distinct upper-case captures of ``pattern`` in a page."""
    return F.array_distinct(F.transform(F.regexp_extract_all(html, F.lit(pattern), 1), F.upper))


def anchor_levels(html: Column, block: str = r"(?s)<nav>(.*?)</nav>") -> Column:
    """Trimmed anchor texts of the first matching block, in page order."""
    inside = F.regexp_extract(html, block, 1)
    texts = F.transform(F.regexp_extract_all(inside, F.lit(r"<a [^>]*>([^<]*)</a>"), 1), lambda t: F.trim(t))
    return F.filter(texts, lambda t: t != "")


def label_value_map(html: Column, pattern: str) -> Column:
    """Map of label to value from a two-group pattern; the last value of a label stays."""
    labels = F.transform(F.regexp_extract_all(html, F.lit(pattern), 1), lambda t: F.trim(t))
    values = F.transform(F.regexp_extract_all(html, F.lit(pattern), 2), lambda t: F.trim(t))
    last = F.filter(
        F.arrays_zip(F.sequence(F.lit(1), F.size(labels)).alias("i"), labels.alias("k"), values.alias("v")),
        lambda e: e["k"] != "",
    )
    keep = F.array_distinct(F.transform(last, lambda e: e["k"]))
    reverse = F.reverse(last)
    picked = F.transform(
        keep, lambda k: F.element_at(F.filter(reverse, lambda e: e["k"] == k), 1)["v"]
    )
    return F.when(F.size(labels) > 0, F.map_from_arrays(keep, picked))


def note_overrides(line: Column) -> dict[str, Column]:
    """Fields of a bullet note: instrument in backticks, target price, year."""
    def found(pattern: str) -> Column:
        return F.nullif(F.regexp_extract(line, pattern, 1), F.lit(""))

    return {
        "ticker": found(r"^\s*-.*?`([A-Z0-9]+)`"),
        "target_price": found(r"(?i)target giá\s+`?(\d+(?:\.\d+)?)`?").try_cast("double"),
        "target_year": found(r"(?i)năm\s+(\d{4})").try_cast("int"),
    }


def embedded_members(html: Column, script_id: str = "__NEXT_DATA__") -> Column:
    """Symbols (else tickers) of the first ``_collection`` list at any depth of a page's embedded JSON, upper case.

    The list's text runs from its bracket to the one that closes it; brackets inside strings and
    nested lists are counted as such.
    """
    script = F.regexp_extract(html, rf'(?s)<script id="{script_id}"[^>]*>(.*?)</script>', 1)
    # any list is the shortest prefix from its bracket that is balanced once strings are blanked out
    rest = F.regexp_extract(script, r'(?s)"_collection"\s*:\s*(\[.*)', 1)
    ends = F.regexp_extract_all(rest, F.lit(r'(?s)"(?:[^"\\]|\\.)*+"|[\[\]]|[^"\[\]]+'), 0)
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("taken"), F.lit(False).alias("closed"))

    def step(at: Column, token: Column) -> Column:
        depth = at["depth"] + F.when(token == "[", 1).when(token == "]", -1).otherwise(0)
        return F.when(at["closed"], at).otherwise(
            F.struct(depth.alias("depth"), F.concat(at["taken"], token).alias("taken"), ((depth == 0) & (token == "]")).alias("closed"))
        )

    listed = F.aggregate(ends, start, step, lambda at: F.when(at["closed"], at["taken"]))
    rows = F.from_json(listed, "array<struct<symbol:string,ticker:string>>")
    names = F.transform(rows, lambda r: F.upper(F.trim(F.coalesce(r["symbol"], r["ticker"]))))
    return F.filter(names, lambda n: n.isNotNull() & (n != ""))
