"""Mixing sources to target weights by pivotal dependent rounding [native: DataFrame functions only].

Each source gets a target number of words. A row of ratio r = target / source size is copied floor(r) times, and once more
with probability frac(r). These fractional copies are rounded together: two rows exchange mass (probability times size), in a
random direction whose odds keep both expectations, until one of them is integral. That row is settled, the other is carried on.
Blocks of rows of a source are folded so in parallel, their residuals meet in blocks of blocks, and so on up a tree; the one
residual of a source is settled by its own odds. Mass is kept at each exchange, so the words that a source yields differ from its
target by less than one row's size, and by no more than a small row's where small rows have room (see settled_items).

Edge cases: a null or empty text has size 0, carries no mass, is copied once and takes 0 words. A null source is a source of its
own, last in order. Rows equal in (id, source, text) are settled together (their whole number of copies first, one fractional
row at most in the tree) and differ by one copy at most, so any number of repeated rows costs one item. A null id is an id.
Empty tables give empty results. Of the input only the named columns are read; others may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lexatlas.functions.numbering import dense_numbers
from lexatlas.llm.common import WORD, columns, let, name, own, staged, table, unit
from lexatlas.llm.uneven import HOT_ROWS, hot_keys, hot_of, join_dealt, key_hash

#: Rows in a block of the tree: its fan-in.
FAN_IN = 128
#: Repeated rows are counted in parts of so many (two to this power) rows of a partition.
PART_BITS = 16
#: A probability this near to 0 or 1 is taken as integral.
EPS = 1e-9
ITEM = ("size", "doc_id", "th", "rows", "base", "p", "u")
#: Tables by source of so many rows and so many bytes a name are broadcast, larger ones meet the items of a hot source in parts.
FEW_SOURCES, SHORT_NAME = 10_000, 512


def exact(mass: Column | str) -> Column:
    """A sum that doesn't depend on the order of its rows."""
    return F.sum((F.col(mass) if isinstance(mass, str) else mass).cast("decimal(28,9)")).cast("double")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(stats: DataFrame, weights=(5.0, 2.0, 1.0), cap: float = 3.0, share: float = 1.0) -> DataFrame:
    """source, source_size -> also target, ratio. Weights repeat over sources in code-point order, null last.

    Targets share `share` of all sizes by weight; those above cap times their source's size stop there and the excess is reshared, until
    none is above. Each round of this is one aggregation over the sources, whose sums don't depend on the order of rows; the level, the
    words for a weight of one, only rises, so rounds end when no source is newly full.
    """
    cyc = F.array(*[F.lit(float(w)) for w in weights])
    ranked = dense_numbers(stats, "k", F.col("source").asc_nulls_last())
    ranked = ranked.withColumn("w", F.get(cyc, ((F.col("k") - 1) % len(weights)).cast("int"))).withColumn("most", F.col("source_size") * F.lit(float(cap)))
    ranked = staged(ranked, "mix-sources")
    level, full = 0.0, -1
    while True:
        is_full = F.col("most") < F.lit(level) * F.col("w")
        r = ranked.agg(
            F.coalesce(exact("source_size"), F.lit(0.0)).alias("all"), F.coalesce(exact(F.when(is_full, F.col("most"))), F.lit(0.0)).alias("stopped"), F.coalesce(exact(F.when(~is_full, F.col("w"))), F.lit(0.0)).alias("open"),
            F.count_if(is_full).alias("full"),
        ).first()
        if r["full"] == full or not r["open"]:
            break
        full, level = r["full"], (r["all"] * share - r["stopped"]) / r["open"]
    target = F.when(F.lit(not r["open"]), F.col("most")).otherwise(F.least(F.col("most"), F.lit(level) * F.col("w")))
    return ranked.withColumn("target", target).select(
        "source", "source_size", "target", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0).alias("ratio")
    )


def _fold(items: Column, id_type: str) -> Column:
    """Fold an array of items: struct(cur, log); log holds settled items with x = 1 for another copy, cur the residual or null."""

    def item(e: Column, p: Column) -> Column:
        return F.struct(*[(p if c == "p" else e[c]).alias(c) for c in ITEM])

    def settle(e: Column, x: Column) -> Column:
        return F.struct(*[e[c].alias(c) for c in ITEM], x.cast("int").alias("x"))

    def exchange(s: Column, e: Column) -> Column:
        a = s["cur"]
        masses = F.struct((a["p"] * a["size"]).alias("pa"), ((1 - a["p"]) * a["size"]).alias("qa"), (e["p"] * e["size"]).alias("pb"), ((1 - e["p"]) * e["size"]).alias("qb"))

        def move(m: Column) -> Column:
            up, down = F.least(m["qa"], m["pb"]), F.least(m["pa"], m["qb"])
            goes_up = e["u"] * (up + down) < down

            def done(d: Column) -> Column:
                a_first = F.when(d["up"], m["qa"] <= m["pb"]).otherwise(m["pa"] <= m["qb"])
                moved = F.when(d["up"], up).otherwise(down)
                pa = a["p"] + F.when(d["up"], moved).otherwise(-moved) / a["size"]
                pb = e["p"] - F.when(d["up"], moved).otherwise(-moved) / e["size"]
                won = F.when(a_first, settle(a, d["up"])).otherwise(settle(e, ~d["up"]))
                return let(
                    F.struct(F.when(a_first, item(e, pb)).otherwise(item(a, pa)).alias("cur"), won.alias("won")),
                    lambda r: F.when(
                        (r["cur"]["p"] > EPS) & (r["cur"]["p"] < 1 - EPS), F.struct(r["cur"].alias("cur"), F.array_append(s["log"], r["won"]).alias("log"))
                    ).otherwise(F.struct(F.lit(None).alias("cur"), F.concat(s["log"], F.array(r["won"], settle(r["cur"], r["cur"]["p"] > 0.5))).alias("log"))),
                )

            return let(F.struct(goes_up.alias("up")), done)

        return F.when(a.isNull(), F.struct(e.alias("cur"), s["log"].alias("log"))).otherwise(let(masses, move))

    item_t = f"struct<size:bigint,doc_id:{id_type},th:bigint,rows:bigint,base:bigint,p:double,u:double>"
    start = F.struct(F.lit(None).cast(item_t).alias("cur"), F.array().cast(f"array<{item_t[:-1]},x:int>>").alias("log"))
    return F.aggregate(items, start, exchange)


def with_source(items: DataFrame, stats: DataFrame, few: int = FEW_SOURCES, hot_rows: int = HOT_ROWS):
    """A join of items or some of them with a table of one row per source, whose key column is s and is dropped."""
    r = stats.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.octet_length(F.col("source").cast("string"))), F.lit(0)).alias("name")).first()
    if r["n"] <= few and r["name"] <= SHORT_NAME:
        return lambda rows, keyed, how="inner": rows.join(F.broadcast(keyed), F.col("source").eqNullSafe(F.col("s")), how).drop("s")
    hot = hot_keys(items, ["source"], hot_rows)
    return lambda rows, keyed, how="inner": join_dealt(rows, keyed, {"source": "s"}, hot, how, by=["doc_id", "th"]).drop("s")


def _tree(loose: DataFrame, seed: int, tag: str, by_source) -> tuple[DataFrame | None, DataFrame]:
    """Fold the items of each source in a tree of blocks: settled items with copies, and at most one residual item a source."""
    id_type = loose.schema["doc_id"].dataType.simpleString()
    key = [F.lit(seed), F.col("doc_id"), F.col("source"), F.col("th")]
    blocks = loose.groupBy("source").agg(F.ceil(F.count(F.lit(1)) / FAN_IN).cast("long").alias("blocks"))
    most = blocks.agg(F.max("blocks").alias("m")).first()["m"]
    if not most:
        return None, loose
    blocks, out = blocks.withColumnRenamed("source", "s"), None
    loose = by_source(loose, blocks).withColumn("block", F.pmod(F.xxhash64(F.lit("block"), *key), F.col("blocks"))).drop("blocks")
    levels = 1 + sum(FAN_IN**k < most for k in range(20))
    for level in range(levels):
        struct = F.struct(*[unit(F.lit(tag), F.lit(level), *key).alias("u") if c == "u" else F.col(c) for c in ITEM])
        folded = loose.groupBy("source", "block").agg(F.sort_array(F.collect_list(struct), asc=False).alias("items"))
        folded = staged(folded.select("source", "block", _fold(F.col("items"), id_type).alias("f")).select("source", "block", "f.cur", "f.log"), f"pivot-{tag}{level}")
        done = folded.select("source", F.explode("log").alias("e")).select("source", *[F.col(f"e.{c}").alias(c) for c in ITEM[:4]], (F.col("e.base") + F.col("e.x")).alias("copies"))
        out = done if out is None else out.unionByName(done)
        loose = folded.where("cur is not null").select("source", F.floor(F.col("block") / FAN_IN).alias("block"), *[F.col(f"cur.{c}").alias(c) for c in ITEM[:6]])
    return out, loose.drop("block")


def settled_items(items: DataFrame, seed: int, by_source) -> DataFrame:
    """source, size, doc_id, th, rows, base, p -> source, size, doc_id, th, rows, copies of all the rows together.

    Items above their source's mean size are folded first. Their residual is settled by its odds, and the mass so gained or lost
    is taken from or given to all smaller items in proportion to their room, which keeps every expectation and the source's mass;
    then the smaller ones are folded. So it is a small item that is left over at the end.
    """
    is_loose = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
    head = ["source", *ITEM[:4]]
    out = items.where(~is_loose).select(*head, (F.col("base") + F.round("p").cast("long")).alias("copies"))
    loose = items.where(is_loose)
    mean = loose.groupBy(F.col("source").alias("s")).agg(F.avg("size").alias("mean"))
    loose = staged(by_source(loose, mean).withColumn("large", F.col("size") > F.col("mean")).drop("mean"), "pivot-items")
    key = [F.lit(seed), F.col("doc_id"), F.col("source"), F.col("th")]
    x = F.when(unit(F.lit("last"), *key) < F.col("p"), 1).otherwise(0)
    large, rest = _tree(loose.where("large").drop("large"), seed, "large", by_source)
    small = loose.where("not large").drop("large")
    if large is not None:
        rest = staged(rest.withColumn("x", x), "pivot-rest")
        out = out.unionByName(large).unionByName(rest.select(*head, (F.col("base") + F.col("x")).alias("copies")))
        owed = rest.select(F.col("source").alias("s"), ((F.col("p") - F.col("x")) * F.col("size")).alias("owed"))
        room = small.groupBy(F.col("source").alias("r")).agg(exact((1 - F.col("p")) * F.col("size")).alias("up"), exact(F.col("p") * F.col("size")).alias("down"))
        share = room.join(owed, F.col("r").eqNullSafe(F.col("s"))).select("s", F.least(F.col("owed") / F.col("up"), F.lit(1.0)).alias("g"), F.least(-F.col("owed") / F.col("down"), F.lit(1.0)).alias("l"))
        small = by_source(small, staged(share, "pivot-share"), "left")
        small = small.withColumn("p", F.when(F.col("g") > 0, F.col("p") + (1 - F.col("p")) * F.col("g")).when(F.col("l") > 0, F.col("p") * (1 - F.col("l"))).otherwise(F.col("p"))).drop("g", "l")
        out = out.unionByName(small.where(~is_loose).select(*head, (F.col("base") + F.round("p").cast("long")).alias("copies")))
        small = small.where(is_loose)
    done, rest = _tree(small, seed, "small", by_source)
    if done is not None:
        out = out.unionByName(done).unionByName(rest.select(*head, (F.col("base") + x).alias("copies")))
    return out


def mix_items(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights=(5.0, 2.0, 1.0), cap: float = 3.0, share: float = 1.0, seed: int = 17, few: int = FEW_SOURCES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per distinct (id, source, text): doc_id, source, size, th (hash of the text), rows, copies (of all these rows
    together), source_size, target, ratio."""
    rows = docs.select(F.col(name(id_col)).alias("doc_id"), F.col(name(source_col)).alias("source"), word_count(F.col(name(text_col))).alias("size"), F.xxhash64(F.col(name(text_col))).alias("th"))
    items = staged(rows.groupBy("doc_id", "source", "size", "th").agg(F.count(F.lit(1)).alias("rows")), "mix-items")
    stats = items.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    stats = staged(source_targets(stats, weights, cap, share), "mix-targets")
    by_source, s = with_source(items, stats, few, hot_rows), stats.withColumnRenamed("source", "s")
    placed = by_source(items, s)
    whole = F.floor("ratio")
    part = F.col("rows") * (F.col("ratio") - whole)
    near = F.floor(part + EPS)
    zero = F.col("size") == 0
    placed = placed.withColumns(
        {"base": F.when(zero, F.col("rows")).otherwise(F.col("rows") * whole + near).cast("long"), "p": F.when(zero, 0.0).otherwise(F.greatest(part - near, F.lit(0.0)))}
    )
    return by_source(settled_items(placed.select("source", "size", "doc_id", "th", "rows", "base", "p"), seed, by_source), s)


def mix_sizes(docs: DataFrame, **options) -> DataFrame:
    """One row per row of docs: doc_id, source, size, source_size, target, copies, taken (copies times size)."""
    step = 4096
    m = mix_items(docs, **options)
    m = m.withColumn("from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1, F.lit(step).cast("long"))))
    m = m.withColumn("i", F.explode(F.sequence(F.col("from"), F.least(F.col("from") + step, F.col("rows")) - 1)))
    each = F.floor(F.col("copies") / F.col("rows"))
    m = m.withColumn("copies", (each + F.when(F.col("i") < F.col("copies") - each * F.col("rows"), 1).otherwise(0)).cast("long"))
    return m.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mix_documents(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **options) -> DataFrame:
    """docs with each row repeated as often as the mix takes it (rows that it takes no time are absent); the same columns."""
    x = own(docs)
    m = mix_items(docs, id_col=id_col, source_col=source_col, text_col=text_col, **options)
    m = staged(m.select(*[F.col(c).alias(x + c) for c in ("doc_id", "source", "th", "rows", "copies")]), "mix-copies")
    d = docs.withColumn(f"{x}h", F.xxhash64(F.col(name(text_col))))
    on = {id_col: f"{x}doc_id", source_col: f"{x}source", f"{x}h": f"{x}th"}
    rows, copies = F.col(f"{x}rows"), F.col(f"{x}copies")
    # repeated rows that are a large part of all meet their item in several tasks
    hot = hot_of(m.select(key_hash(list(on.values())).alias("h"), rows.alias("n")), options.get("hot_rows", HOT_ROWS))
    joined = join_dealt(d, m, on, hot)
    both = joined.where(rows == 1)
    if not m.where(rows > 1).isEmpty():
        # rows alike in id, source and text share their copies: they are laid down in parts by where they were read, so that any number of
        # them is no single task's, and the parts are counted
        key = [f"{x}doc_id", f"{x}source", f"{x}th"]
        at = d.withColumn(f"{x}part", F.shiftright(F.monotonically_increasing_id(), PART_BITS))
        many = staged(join_dealt(at, m.where(rows > 1), on, hot), "mix-repeated")
        parts = many.groupBy(*key, f"{x}part").agg(F.count(F.lit(1)).alias(f"{x}n"))
        before = F.coalesce(F.sum(f"{x}n").over(W.partitionBy(*key).orderBy(f"{x}part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
        parts = staged(parts.select(*[F.col(c).alias(f"{c}_") for c in (*key, f"{x}part")], before.alias(f"{x}before")), "mix-parts")
        same = F.lit(True)
        for c in (*key, f"{x}part"):
            same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
        inside = F.row_number().over(W.partitionBy(*key, f"{x}part").orderBy(F.xxhash64(*columns(docs.columns))))
        each = F.floor(copies / rows)
        many = many.withColumn(f"{x}i", inside).join(parts, same).withColumn(f"{x}i", F.col(f"{x}i") + F.col(f"{x}before"))
        many = many.withColumn(f"{x}copies", (each + F.when(F.col(f"{x}i") <= copies - each * rows, 1).otherwise(0)).cast("long"))
        both = both.unionByName(many.select(*columns(joined.columns)))
    return both.where(copies > 0).withColumn(f"{x}c", F.explode(F.sequence(F.lit(1).cast("long"), copies))).select(*columns(docs.columns))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(table(spark, sf_dir, "documents"), weights=(5.0, 2.0, 1.0), cap=3.0, share=1.0)
