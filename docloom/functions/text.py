"""Text functions as Columns: quality, normalisation, shingles, previews, extraction. All of them stay in the JVM."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from .paths import strip

#: fixed values: markers of navigation pages
BOILERPLATE = ("previous", "next", "navigation", "table of contents", "show source")
#: fixed values: endings of a file's stem that don't tell families apart
STEM_NUMBER = r"(?:[_\-\s]|\()\d{1,3}\)?$"
STEM_MARKS = r"(?:[\s_\-]copy|[\s_\-]final|[\s_\-]signed|[\s_\-]scan(?:ned)?|[\s_\-]ocr)+$"
#: fixed values: lines that only page through a document, lower-cased
PAGE_LINE = r"^(?:page \d+ of \d+|page \d+|\d+/\d+|\d+|printed on .+|generated on .+|created on .+)$"
REPEATED_LINES, REPEATED_LENGTH = 3, 120


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _share(c: Column, keep: str) -> Column:
    """Share of the characters that are in the class ``keep``; null for an empty text."""
    return F.length(F.regexp_replace(c, f"[^{keep}]", "")) / F.nullif(F.length(c), F.lit(0))


def printable_share(c: Column) -> Column:
    return F.length(F.regexp_replace(c, r"[\p{Cc}\p{Cf}\p{Cs}\p{Co}\p{Cn}\p{Zl}\p{Zp}\x{a0}\x{1680}\x{2000}-\x{200a}\x{202f}\x{205f}\x{3000}&&[^\n\r\t]]", "")) / F.nullif(F.length(c), F.lit(0))


def alpha_share(c: Column) -> Column:
    return _share(c, r"\p{L}")


def parse_quality(c: Column) -> Column:
    """Six-level quality of a parsed text (0, .1, .3, .4, .8, 1); null and blank texts score 0."""

    def score(full: Column, sample: Column, printable: Column, alpha: Column) -> Column:
        low = F.lower(sample)
        hits = sum((F.contains(low, F.lit(m)).cast("int") for m in BOILERPLATE), F.lit(0))
        return F.when(full == "", 0.0).when(F.length(full) < 50, 0.3).when(printable < 0.7, 0.1).when(alpha < 0.2, 0.3).when(hits >= 3, 0.4).when((alpha > 0.5) & (printable > 0.95), 1.0).otherwise(0.8)

    return let(strip(F.coalesce(c, F.lit(""))), lambda full: let(F.substring(full, 1, 2000), lambda x: let(printable_share(x), lambda p: let(alpha_share(x), lambda a: score(full, x, p, a)))))


def text_file_quality(c: Column) -> Column:
    """Quality of a plain text file (0, .2, .5, 1)."""
    full = strip(F.coalesce(c, F.lit("")))
    return F.when(full == "", 0.0).when(printable_share(F.substring(c, 1, 2000)) < 0.8, 0.2).when(F.length(full) < 50, 0.5).otherwise(1.0)


def ocr_quality(c: Column, short: int = 50, good: float = 0.9) -> Column:
    """Quality of recognised text (0, .3, .4, good) by length and share of letters."""
    full = strip(F.coalesce(c, F.lit("")))
    return F.when(full == "", 0.0).when(F.length(full) < short, 0.3).when(alpha_share(full) < 0.3, 0.4).otherwise(good)


def quality_bucket(c: Column) -> Column:
    return F.when(c.isNull(), "missing").when(c >= 0.95, "0.95-1.00").when(c >= 0.85, "0.85-0.94").when(c >= 0.70, "0.70-0.84").otherwise("<0.70")


def numeric_dump(c: Column) -> Column:
    """Long texts that are mostly digits and hardly letters."""
    solid = F.regexp_replace(c, r"\s", "")
    n = F.length(solid)
    return F.coalesce((n >= 80) & (F.length(F.regexp_replace(solid, r"[^\p{Nd}]", "")) >= 0.55 * n) & (F.length(F.regexp_replace(solid, r"[^\p{L}]", "")) <= 0.2 * n), F.lit(False))


def preview(c: Column, most: int = 180) -> Column:
    flat = strip(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    return F.when(F.length(flat) <= most, flat).otherwise(F.concat(strip(F.substring(flat, 1, most - 3)), F.lit("...")))


def markdown_cell(c: Column) -> Column:
    return F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def normalized_lines(c: Column) -> Column:
    """Trimmed, lower-cased lines without page counters, after joining broken words and collapsing blanks."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"\r\n?", "\n")
    t = F.regexp_replace(t, r"([\p{L}\p{N}_])-\n([\p{L}\p{N}_])", "$1$2")
    t = F.regexp_replace(t, r"[ \t]+", " ")
    lines = F.transform(F.split(t, "\n"), lambda x: F.lower(strip(x)))
    return F.filter(lines, lambda x: (x != "") & ~F.rlike(x, F.lit(PAGE_LINE)))


def without_repeats(lines: Column) -> Column:
    """Short lines that stand three times or more are headers or footers; they go unless nothing else is left.

    In the sorted lines such a line equals the one two places on, so the cost is that of a sort.
    """

    def repeated(s: Column) -> Column:
        last = F.size(s) - (REPEATED_LINES - 1)
        return F.array_distinct(F.filter(s, lambda x, i: (i < last) & (F.length(x) <= REPEATED_LENGTH) & (F.get(s, i + (REPEATED_LINES - 1)) == x)))

    def kept(l: Column) -> Column:
        return let(let(F.array_sort(l), repeated), lambda r: F.when(F.size(r) == 0, l).otherwise(let(F.filter(l, lambda x: ~F.array_contains(r, x)), lambda k: F.when(F.size(k) > 0, k).otherwise(l))))

    return let(lines, kept)


def normalized_text(c: Column) -> Column:
    return F.array_join(without_repeats(normalized_lines(c)), "\n")


def word_tokens(c: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[a-z0-9]+"), F.lit(0))


def word_shingles(c: Column, k: int = 5) -> Column:
    """Distinct runs of ``k`` words; a shorter text is one run."""

    def runs(t: Column) -> Column:
        many = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(t) - k + 1)), lambda i: F.array_join(F.slice(t, i, k), " "))
        return F.when(F.size(t) == 0, F.array().cast("array<string>")).when(F.size(t) <= k, F.array(F.array_join(t, " "))).otherwise(F.array_distinct(many))

    return let(word_tokens(c), runs)


def line_units(c: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.coalesce(c, F.lit("")), "\n"), lambda x: x != ""))


def containment(a: Column, b: Column) -> Column:
    least = F.least(F.size(a), F.size(b))
    return F.when(least <= 0, 0.0).otherwise(F.size(F.array_intersect(a, b)) / least)


def similarity(a: Column, b: Column) -> Column:
    """The better of line and 5-word containment, to four places."""
    return F.round(F.greatest(containment(line_units(a), line_units(b)), containment(word_shingles(a), word_shingles(b))), 4)


def stem_key(stem: Column) -> Column:
    """Loose family key of a file stem; the lower-cased stem where nothing is left."""
    s = F.replace(F.lower(stem), F.lit("&"), F.lit(" and "))
    s = F.regexp_replace(F.regexp_replace(s, STEM_NUMBER, ""), STEM_MARKS, "")
    key = F.array_join(F.regexp_extract_all(s, F.lit(r"[a-z0-9]+"), F.lit(0)), " ")
    return F.when(key == "", F.lower(stem)).otherwise(key)


def html_text(c: Column) -> Column:
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"(?is)<script[^>]*>.*?</script>", "")
    t = F.regexp_replace(t, r"(?is)<style[^>]*>.*?</style>", "")
    return strip(F.regexp_replace(F.regexp_replace(t, r"<[^>]+>", " "), r"\s+", " "))


def xml_text(c: Column) -> Column:
    """Text nodes, one per line."""
    t = F.regexp_replace(F.coalesce(c, F.lit("")), r"<[^>]+>", "\n")
    return F.array_join(F.filter(F.transform(F.split(t, "\n"), lambda x: strip(x)), lambda x: x != ""), "\n")


def event_line(xml: Column) -> Column:
    """``[time] EventID=n Provider=p | data`` of an event record, or an empty text."""
    first = lambda *rx: F.coalesce(*(F.nullif(F.regexp_extract(xml, r, 1), F.lit("")) for r in rx), F.lit(""))
    ts = first(r"<TimeCreated[^>]*?SystemTime=['\"]([^'\"]+)['\"]", r"<TimeCreated[^>]*?>([^<]+)<")
    eid, prov = first(r"<EventID[^>]*?>([^<]+)<"), first(r"<Provider\s+Name=['\"]([^'\"]+)['\"]", r"<Provider[^>]*?>([^<]+)<")
    data = F.slice(F.regexp_extract_all(xml, F.lit(r"<Data[^>]*>([^<]+)</Data>"), F.lit(1)), 1, 5)
    tail = F.when(F.size(data) > 0, F.concat(F.lit(" | "), F.array_join(data, " "))).otherwise("")
    return F.when((ts != "") | (eid != ""), F.concat(F.lit("["), ts, F.lit("] EventID="), eid, F.lit(" Provider="), prov, tail)).otherwise("")


def byte_runs(content: Column, least: int = 8) -> Column:
    """Runs of printable bytes of which more than half are letters or blanks, one per line."""
    runs = F.regexp_extract_all(F.decode(content, "ISO-8859-1"), F.lit(rf"[\t\n\r -~]{{{least},}}"), F.lit(0))
    runs = F.filter(F.transform(runs, lambda x: strip(x)), lambda x: (F.length(x) > least) & (F.length(F.regexp_replace(x, r"[^A-Za-z\s]", "")) * 2 > F.length(x)))
    return F.array_join(runs, "\n")


def token_estimate(c: Column) -> Column:
    return F.greatest(F.lit(1), F.floor(F.length(F.coalesce(c, F.lit(""))) / 4)).cast("int")


def context_window(doc: Column, chunk: Column, whole: int = 56_000, window: int = 20_000) -> Column:
    """The document if short enough, else a window centred on the chunk, marked where it was cut."""
    n, m, half = F.length(doc), F.length(chunk), window // 2
    at = F.instr(doc, F.substring(chunk, 1, 200)) - 1
    s0, e0 = F.greatest(F.lit(0), at - half), F.least(n, at + m + half)
    end = F.when(s0 == 0, F.least(n, F.lit(window))).otherwise(e0)
    start = F.when((s0 != 0) & (e0 == n), F.greatest(F.lit(0), n - window)).otherwise(s0)
    cut = F.concat(F.when(start > 0, "... ").otherwise(""), F.substring(doc, start + 1, end - start), F.when(end < n, " ...").otherwise(""))
    return F.when(n <= whole, doc).when(at < 0, F.substring(doc, 1, window)).otherwise(cut)


def enriched(preamble: Column, text: Column, least: int = 10) -> Column:
    return F.when(F.length(preamble) > least, F.concat(preamble, F.lit("\n\n"), text))


def rewrite(c: Column, rules: list[tuple[str, str]]) -> Column:
    """Ordered case-insensitive regular-expression replacements; a pattern that is no expression is taken literally."""
    for pattern, to in rules:
        try:
            re.compile(pattern)
        except re.error:
            pattern, to = f"\\Q{pattern}\\E", to.replace("\\", "\\\\").replace("$", "\\$")
        c = F.regexp_replace(c, f"(?i){pattern}", to)
    return c


def has_value(c: Column, kind: str) -> Column:
    """Not null, not an empty string, not an empty container; zero and false are values."""
    if kind == "string":
        return c.isNotNull() & (c != "")
    if kind.startswith(("array", "map")):
        return c.isNotNull() & (F.size(c) > 0)
    return c.isNotNull()
