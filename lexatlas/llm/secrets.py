"""Secret scans with multipart credential linking [native: DataFrame functions only].

Three base kinds are reported wherever they occur: `assign` (a keyword, a separator and a value of 12 or more characters),
`access` (AKIA identifiers of 18 or more) and `hex` (runs of 16 or more). Three weak kinds are only candidates:
`ident` (a user, login, client or access-key name with its value), `weak` (a keyword with a value of 4 to 11 characters; pwd or pass,
which `assign` doesn't know, with a value of 4 or more; or a bare token of 32 or more with small and capital letters and digits) and `endpoint` (a service address with a scheme, or host/endpoint/server with its value). A weak
candidate is reported when complementary parts of a credential lie in its scope, SCOPE characters to either side: a weak secret
beside an identifier (ident or access), an identifier beside a secret (assign or weak), an endpoint beside both. A candidate that
overlaps a base span is a part for its neighbours but no finding of its own.

The interval join of the parts runs inside each row as a sweep: the spans of a text, sorted by start, are folded forwards with
the furthest end seen of each part and backwards with the nearest start (two spans are in scope if the gap between them is SCOPE or
less), so the work is linear in the spans and nothing is
shuffled, however many copies of a text there are. Offsets are code points, ends exclusive.

Edge cases: a null text is empty and has no spans. Copies get equal spans. The input's columns are kept, whatever
their names. Empty tables give empty results. Only ASCII letters fold case.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexatlas.functions.folds import gather
from lexatlas.llm.common import columns, name, own, table

KINDS = ("assign", "access", "hex", "ident", "weak", "endpoint")
BASE = 3
SCOPE = 200

#: The patterns of the base kinds, and the shortest match that counts (of group 2 for assign).
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 12, "access": 18, "hex": 16}
#: The weak kinds. A secret's value has 4 to 11 characters, after pwd and pass 4 or more; a bare token needs small and capital letters and digits.
IDENT = r"""(?i)(?:access_?key(?:_?id)?|client_?id|user(?:_?name)?|login|account)["']?\x20*[:=]\x20*["']?[A-Za-z0-9_.@+-]{3,}"""
SHORT = r"""(?i)(?:password|passwd|pwd|pass|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BARE = r"[A-Za-z0-9+/]{32,}"
ENDPOINT = r"""(?i)(?:https?|ftp|sftp|ssh|ldap|amqps?|rediss?|mongodb|mysql|postgres(?:ql)?)://[^\x09-\x0D\x20"'<>]+|(?:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]+(?::[0-9]+)?"""
SHORT_MOST, SHORT_LEAST = 11, 4
#: The matches of SHORT that are weak: longer values are of kind assign, but for keywords that ASSIGN doesn't have.
SHORT_KEPT = rf"""(?i)^(?:(?:pwd|pass)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{{{SHORT_LEAST},}}|[a-z_]+["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{{{SHORT_LEAST},{SHORT_MOST}}})$"""

SPAN = "struct<start:int,kind:int,end:int>"


def _spans(text: Column, hits: Column, pattern: str, kind: str, group: Column | None, keep) -> Column:
    """Where hits, all matches of pattern in text, lie: the pieces between them tell the offsets. Those stay whose group is kept."""
    gaps = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    shown = hits if group is None else group
    rows = F.zip_with(F.arrays_zip(gaps.alias("gap"), hits.alias("hit")), shown, lambda z, g: F.struct(z["gap"].alias("gap"), F.length(z["hit"]).alias("n"), keep(g).alias("keep")))
    rows = F.filter(rows, lambda z: z["n"].isNotNull())

    def step(s: Column, z: Column):
        begin = s["at"] + z["gap"]
        return {"at": begin + z["n"]}, F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("kind"), (begin + z["n"]).alias("end"), z["keep"].alias("keep"))

    found = gather(rows, {"at": F.lit(0)}, step, "struct<start:int,kind:int,end:int,keep:boolean>")
    found = F.transform(F.filter(found, lambda x: x["keep"]), lambda x: F.struct(x["start"], x["kind"], x["end"]))
    return F.when(F.exists(shown, keep), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def _linked(spans: Column, scope: int) -> Column:
    """Base spans and those weak ones whose complements lie in scope, by start, then kind."""
    none = F.lit(-(2**30))
    ident, secret = lambda k: k.isin(1, 3), lambda k: k.isin(0, 4)

    def sweep(items: Column, forwards: bool) -> Column:
        def step(s: Column, e: Column):
            begin, end = (e["start"], e["end"]) if forwards else (-e["end"], -e["start"])
            near = lambda last: begin - last <= scope
            seen = F.struct(
                e["start"].alias("start"), e["kind"].alias("kind"), e["end"].alias("end"),
                (e["id"] | near(s["ident"])).alias("id"), (e["se"] | near(s["secret"])).alias("se"), (e["over"] | (s["base"] > begin)).alias("over"),
            )
            new = {
                "ident": F.when(ident(e["kind"]), F.greatest(s["ident"], end)).otherwise(s["ident"]),
                "secret": F.when(secret(e["kind"]), F.greatest(s["secret"], end)).otherwise(s["secret"]),
                "base": F.when(e["kind"] < BASE, F.greatest(s["base"], end)).otherwise(s["base"]),
            }
            return new, seen

        return gather(items, {"ident": none, "secret": none, "base": none}, step, "struct<start:int,kind:int,end:int,id:boolean,se:boolean,over:boolean>")

    flagged = F.transform(F.array_sort(spans), lambda x: F.struct(x["start"], x["kind"], x["end"], F.lit(False).alias("id"), F.lit(False).alias("se"), F.lit(False).alias("over")))
    both = sweep(F.reverse(sweep(flagged, True)), False)
    kept = F.filter(
        both,
        lambda x: (x["kind"] < BASE) | (~x["over"] & F.when(x["kind"] == 3, x["se"]).when(x["kind"] == 4, x["id"]).otherwise(x["se"] & x["id"])),
    )
    return F.array_sort(F.transform(kept, lambda x: F.struct(x["start"], x["kind"], x["end"])))


def find_secrets(docs: DataFrame, *, text_col: str = "text", to: str = "spans", scope: int = SCOPE) -> DataFrame:
    """docs with the column `to` (which replaces one of that name): an array of struct(start, kind, end) by start, then kind; kind is
    an index into KINDS."""
    x = own(docs)
    kept = [c for c in docs.columns if c.lower() != to.lower()]
    d = docs.withColumn(f"{x}text", F.coalesce(F.col(name(text_col)).cast("string"), F.lit("")))
    text = F.col(f"{x}text")
    hex_runs = HEX[:-1] + f"{{{LEAST['hex']},}}"
    at_least = lambda n: lambda g: F.length(g) >= n
    short = lambda g: g.rlike(SHORT_KEPT)
    mixed = lambda g: g.rlike("[a-z]") & g.rlike("[A-Z]") & g.rlike("[0-9]")
    pair = text.contains(":") | text.contains("=")  # what stands between a name and its value
    always = F.lit(True)
    #: name, kind, pattern, group that is looked at, what it must be; what a text must hold for any match, so that others aren't searched
    rules = [
        ("assign", "assign", ASSIGN, 2, at_least(LEAST["assign"]), pair), ("access", "access", ACCESS, 0, at_least(LEAST["access"]), text.contains("AKIA")), ("hex", "hex", hex_runs, 0, at_least(LEAST["hex"]), always),
        ("ident", "ident", IDENT, 0, at_least(0), pair), ("short", "weak", SHORT, 0, short, pair), ("bare", "weak", BARE, 0, mixed, always), ("endpoint", "endpoint", ENDPOINT, 0, at_least(0), pair),
    ]
    hits = lambda p, g, holds: F.when(holds, F.regexp_extract_all(text, F.lit(p), F.lit(g))).otherwise(F.array().cast("array<string>"))
    d = d.withColumns({f"{x}{n}0": hits(p, 0, holds) for n, _, p, _, _, holds in rules})
    # groups are taken only of what matched
    d = d.withColumns({f"{x}{n}{g}": hits(p, g, F.size(f"{x}{n}0") > 0) for n, _, p, g, _, _ in rules if g})
    spans = {n: _spans(text, F.col(f"{x}{n}0"), p, kind, F.col(f"{x}{n}{g}") if g else None, keep) for n, kind, p, g, keep, _ in rules}
    base = F.concat(*[spans[k] for k in KINDS[:BASE]])
    weak = F.concat(*[spans[n] for n, kind, *_ in rules if kind not in KINDS[:BASE]])
    some = F.size(f"{x}ident0") + F.size(f"{x}short0") + F.size(f"{x}bare0") + F.size(f"{x}endpoint0") > 0
    d = d.withColumn(f"{x}base", base)
    d = d.withColumn(f"{x}spans", F.when(some, _linked(F.concat(F.col(f"{x}base"), weak), scope)).otherwise(F.array_sort(F.col(f"{x}base"))))
    return d.select(*columns(kept), F.col(f"{x}spans").alias(to))


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string"))), ",")


def redact(docs: DataFrame, *, text_col: str = "text", mark: str = "[SECRET]", scope: int = SCOPE) -> DataFrame:
    """docs with every span of the text replaced by mark, spans that touch as one; the same columns."""
    spans, text = f"{own(docs)}spans", F.col(name(text_col))
    found = find_secrets(docs, text_col=text_col, to=spans, scope=scope)

    def step(s: Column, e: Column):
        fresh = e["start"] > s["end"]
        gap = F.when(fresh, F.substring(text, s["end"] + 1, e["start"] - s["end"])).otherwise("")
        return {"end": F.greatest(s["end"], e["end"])}, F.when(fresh | (s["end"] == 0), F.concat(gap, F.lit(mark))).otherwise(gap)

    last = F.array_max(F.transform(spans, lambda x: x["end"]))
    cut = F.concat(F.array_join(gather(F.col(spans), {"end": F.lit(0)}, step, "string"), ""), F.substring(text, last + 1, F.lit(2**30)))
    clean = F.when(F.size(spans) > 0, cut).otherwise(text)
    return found.select(*[clean.alias(c) if c == text_col else F.col(name(c)) for c in docs.columns])


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda x: x["kind"] < BASE)
    count = lambda k: F.size(F.filter("spans", lambda x: x["kind"] == k)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"),
    )


def _sql_pattern(pattern: str) -> str:
    """A pattern for DuckDB: quotes doubled; letters in either case as classes, since (?i) folds more than ASCII there."""
    fold = pattern.startswith("(?i)")
    out, depth, k = "", 0, 4 if fold else 0
    while k < len(pattern):
        ch = pattern[k]
        if ch == "\\":
            n = 4 if pattern[k + 1] == "x" else 2
            out += pattern[k : k + n]
            k += n
            continue
        depth += (ch == "[") - (ch == "]")
        out += f"[{ch.upper()}{ch}]" if fold and ch.isalpha() and ch.islower() and not depth else ch
        k += 1
    return out.replace("'", "''")


def op8_sql() -> str:
    """DuckDB SQL with the result of op8_secret_scan."""
    short = f"(length(g) BETWEEN {SHORT_LEAST} AND {SHORT_MOST} OR length(g) >= {SHORT_LEAST} AND regexp_matches(h, '^[pP]([wW][dD]|[aA][sS][sS])[\"'']?\\x20*[:=]'))"
    rules = [
        (0, ASSIGN, 2, f"length(g) >= {LEAST['assign']}"), (1, ACCESS, 0, f"length(g) >= {LEAST['access']}"), (2, HEX, 0, f"length(g) >= {LEAST['hex']}"), (3, IDENT, 0, "true"),
        (4, SHORT, 1, short), (4, BARE, 0, "regexp_matches(g, '[a-z]') AND regexp_matches(g, '[A-Z]') AND regexp_matches(g, '[0-9]')"), (5, ENDPOINT, 0, "true"),
    ]
    hits = " UNION ALL ".join(
        f"SELECT r, text, {kind} AS kind, regexp_extract_all(text, '{p}') AS h, string_split_regex(text, '{p}') AS pieces, "
        f"list_transform(list_zip(regexp_extract_all(text, '{p}'), regexp_extract_all(text, '{p}', {group})), lambda z: {keep}) AS ok FROM d WHERE regexp_matches(text, '{p}')"
        for kind, pattern, group, keep in ((k, p, g, re.sub(r"\b([gh])\b(?=[,)])", lambda m: "z[2]" if m[1] == "g" else "z[1]", c)) for k, p, g, c in rules)
        for p in (_sql_pattern(pattern),)
    )
    names = "[" + ", ".join(f"'{k}'" for k in KINDS) + "]"
    near = f"greatest(w.s - p.s2, p.s - w.s2) <= {SCOPE}"
    exists = lambda what, where: f"EXISTS (SELECT 1 FROM parts p WHERE p.r = w.r AND {what} AND {where})"
    secret, ident, base = exists("p.kind IN (0, 4)", near), exists("p.kind IN (1, 3)", near), exists("p.kind < 3", "p.s < w.s2 AND w.s < p.s2")
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
hits AS ({hits}),
each AS (SELECT r, kind, h, pieces, ok, unnest(range(1, len(h) + 1)) AS i FROM hits),
parts AS (
  SELECT r, kind, (list_sum(list_transform(pieces[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0))::BIGINT AS s, s + length(h[i]) AS s2
  FROM each WHERE ok[i]
),
found AS (
  SELECT * FROM parts WHERE kind < 3
  UNION ALL SELECT * FROM parts w WHERE kind >= 3 AND NOT {base} AND CASE kind WHEN 3 THEN {secret} WHEN 4 THEN {ident} ELSE {secret} AND {ident} END
),
named AS (SELECT r, kind, s, s2, ({names})[kind + 1] || ':' || s || ':' || s2 AS label FROM found),
g AS (
  SELECT r, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
    string_agg(label, ',' ORDER BY s, kind, s2) FILTER (kind < 3) AS base, string_agg(label, ',' ORDER BY s, kind, s2) AS spans FROM named GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (r)
"""
