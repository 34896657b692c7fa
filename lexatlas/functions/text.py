"""Column helpers for text: one definition of white space, headings, JSON repair and the rest. All run in the JVM but cut_array."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lexatlas.functions.folds import gather

#: White space as Python's regular expressions understand it; Java's own class misses some of these.
WS = r"[\s\x1c-\x1f]"
#: Regions that dictionary matching leaves alone, each pattern run over the whole text.
SKIP = (r"(?d)```[\s\S]*?```", r"(?d)\$\$[\s\S]*?\$\$", r"(?d)`[^`]+`", r"(?d)\$[^$\n]+?\$", r"(?d)!\[.*?\]\(.*?\)")


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(x: Column | str) -> Column:
    return F.regexp_replace(_c(x), rf"(?U)^{WS}+|{WS}+\z", "")


def lstrip(x: Column | str) -> Column:
    return F.regexp_replace(_c(x), rf"(?U)^{WS}+", "")


def collapse(x: Column | str) -> Column:
    """Runs of white space as one space, none at the ends."""
    return strip(F.regexp_replace(_c(x), rf"(?U){WS}+", " "))


def sanitize_filename(x: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(_c(x), r'[<>:"/\\|?*]', "_"), r"^[. ]+|[. ]+\z", "")


def split_at_headings(x: Column | str, level: int) -> Column:
    """Pieces of a text, each but the first beginning with a heading of that level; line ends are \\n only."""
    return F.split(_c(x), rf"(?mdU)(?=^{'#' * level}{WS})", -1)


def repair_json_backslashes(x: Column | str) -> Column:
    r"""Doubles each backslash that doesn't begin an escape of JSON; what is an escape by chance (\frac) stays one.

    Of the two groups only one matches at a time, so an escape stays and a lone backslash comes twice; one pass, no recursion.
    """
    return F.regexp_replace(_c(x), r'(\\["\\/bfnrtu])|(\\)', "$1$2$2")


def decoded_control_escapes(x: Column | str) -> Column:
    r"""How many escapes of the text are probably commands of a formula, such as \frac or \nu."""
    return F.regexp_count(_c(x), F.lit(r"(?<!\\)(?:\\\\)*\\[bfnrtu][a-z]{2,}"))


def strip_fences(x: Column | str) -> Column:
    """A reply without the code fence around it."""
    return strip(F.regexp_replace(F.regexp_replace(strip(x), r"^(?:```json)?(?:```)?", ""), r"```\z", ""))


def chapters_json(x: Column | str) -> Column:
    """The array behind the key "chapters", or null."""
    found = F.regexp_extract(_c(x), r'(?s)"chapters"\s*:\s*(\[.*\])', 1)
    return F.when(found != "", found)


def chapters_rest(x: Column | str) -> Column:
    """All that stands from the array behind the key "chapters" on, or null; the array may be broken off."""
    found = F.regexp_extract(_c(x), r'(?s)"chapters"\s*:\s*(\[.*)', 1)
    return F.when(found != "", found)


_JSON_TOKEN = re.compile(r'"(?:[^"\\]|\\.)*+"|["\[\]{},]', re.S)


def array_elements(text: str) -> list[str]:
    """The elements of the JSON array that a text begins with, as they stand: cut at commas outside strings and inner brackets, up to the
    bracket that ends the array, or to the end of a text that breaks off. One pass."""
    out, depth, start = [], 0, 0
    for m in _JSON_TOKEN.finditer(text):
        c = m[0]
        if c == '"':  # a string that nothing ends
            break
        if c in "[{":
            depth += 1
            start = m.end() if depth == 1 else start
        elif c in "]}" or c == "," and depth == 1:
            depth -= c != ","
            if depth == 0 or c == ",":
                out.append(text[start : m.start()].strip())
                start = m.end()
            if depth == 0:
                return [e for k, e in enumerate(out) if e or len(out) > 1]
    return [*out, rest] if (rest := text[start:].strip()) else out


def cut_array(x: Column | str) -> Column:
    """array_elements of a column; null for null."""

    @F.pandas_udf("array<string>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([None if t is None else array_elements(t) for t in texts], dtype=object)

    return run(_c(x))


def first_filled(*xs: Column | str) -> Column:
    """The first of xs that isn't null or empty, else an empty string."""
    return F.coalesce(*[F.nullif(_c(x), F.lit("")) for x in xs], F.lit(""))


def preview(x: Column | str, n: int = 200) -> Column:
    return F.when(F.length(_c(x)) > n, F.concat(F.substring(_c(x), 1, n), F.lit("..."))).otherwise(_c(x))


def embedding_text(title: Column | str, content: Column | str) -> Column:
    return F.concat(F.coalesce(_c(title), F.lit("")), F.lit("。"), F.coalesce(_c(content), F.lit("")))


def concept_code(n: Column | str) -> Column:
    """C001, C002, ..., C1000: three digits at least."""
    return F.format_string("C%03d", _c(n).cast("long"))


def fixed(x: Column | str, digits: int = 3) -> Column:
    """A number with so many digits, for reports only: ties round up."""
    return F.format_string(f"%.{digits}f", _c(x))


def lookup(x: Column | str, table: dict[str, str], otherwise: Column | str) -> Column:
    pairs = [F.lit(v) for kv in table.items() for v in kv]
    return F.coalesce(F.element_at(F.create_map(*pairs), _c(x)), _c(otherwise) if isinstance(otherwise, Column) else F.lit(otherwise))


def iso_time(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss")


def stem(path: Column | str) -> Column:
    return F.regexp_replace(F.regexp_extract(_c(path), r"([^/]*)\z", 1), r"(?<=.)\.[^.]*\z", "")


def pretty_path(path: Column | str) -> Column:
    return F.replace(_c(path), F.lit(".json"), F.lit("_pretty.json"))


def first_level(line: Column, rules: list[tuple[int, str]]) -> Column:
    """The level of the first rule whose pattern matches at the beginning of line, or null."""
    out = F.lit(None).cast("int")
    for level, pattern in reversed(rules):
        out = F.when(line.rlike(f"^(?:{pattern})"), F.lit(level)).otherwise(out)
    return out


def offsets(text: Column, pattern: str) -> Column:
    """array<struct(start, end)> of all matches of pattern: the pieces between them give the offsets."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    pairs = F.filter(F.zip_with(gaps, hits, lambda g, h: F.struct(F.length(g).alias("g"), F.length(h).alias("n"))), lambda z: z["n"].isNotNull())

    def step(s: Column, z: Column):
        begin = s["at"] + z["g"]
        return {"at": begin + z["n"]}, F.struct(begin.alias("start"), (begin + z["n"]).alias("end"))

    return gather(pairs, {"at": F.lit(0)}, step, "struct<start:int,end:int>")


def skip_ranges(text: Column | str) -> Column:
    """Code, formulas and images of a markdown text, sorted by start: array<struct(start, end)>, code points, end exclusive."""
    return F.array_sort(F.concat(*[offsets(_c(text), p) for p in SKIP]))
