"""SimHash near-duplicates by multi-index hashing.

Texts are fingerprinted in 64 bits over word shingles. Distinct fingerprints are the nodes; two are linked at MAX_DISTANCE or
fewer differing bits. A fingerprint is cut into two segments of 32 bits. For each segment all values within one bit of its own
are looked up, and two fingerprints meet in a segment's table if their values differ in two bits or fewer; five differing bits
or fewer can't have three in both segments, so no link is missed. Those that meet are verified by their complete distance.

Meetings are counted before anything is gathered. Where two fingerprints meet at a key, they are a pair. Where up to GROUP_MOST
meet, one task tries them breadth-first and emits a spanning forest, never all pairs. Where more meet, they are dealt again by
small balls of the other segment (two bits around the key's own values, one bit around values next to it): any two that meet
there are within 4 bits, and any two within 4 bits meet at some key, so a star per key is exact and linear in the group. For an odd
distance the balls of the next even one are taken; as two that meet can then be a bit too far, each cell is tried breadth-first.
A cell has 1,600 fingerprints at most.
Components of the links come from distributed star rounds; no list of links or fingerprints reaches the driver.
Where rows meet a key, a fingerprint or the centre of a component that holds a large part of them, they are dealt to several tasks.

Edge cases: a null or empty text has fingerprint zero and is linked like any other. Copies share a fingerprint, one node. Null ids
come after all others: a component of null ids only has a null component_id. Other columns may have any names. Empty tables
give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexatlas.llm.common import columns, name, own, ready_python, staged, table
from lexatlas.llm.components import components
from lexatlas.llm.uneven import HOT_ROWS, hot_keys, hot_of, join_dealt, key_hash

SHINGLE, SEED, MAX_DISTANCE = 4, 42, 4
#: So many fingerprints at one key are compared in one task, 8 bytes each.
GROUP_MOST = 2048
#: Bits of the filter before the join with these keys: 6 MB at most when broadcast.
FILTER_BITS = 1 << 24
#: Fingerprints whose lookups one task makes.
FPS_A_TASK = 1 << 14
LOW = (1 << 32) - 1
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The 64 bits as a signed integer. Words are split at ASCII white space, A-Z are lower-cased."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    line, n = b" ".join(words), len(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    first = max(0, min(shingle, n) - 1)
    stops = ends[first:].tolist()
    starts = [0, *(ends[: len(stops) - 1] + 1).tolist()]
    digest, total = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(stops), 1 << 15):
        h = np.array([digest(line[i:j], seed) for i, j in zip(starts[k : k + (1 << 15)], stops[k : k + (1 << 15)], strict=True)], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(stops), bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", to: str = "fp", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    ready_python(docs.sparkSession)

    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series([fingerprint(x, shingle, seed) for x in t], dtype="int64")

    return docs.withColumn(to, fp(F.col(name(text_col)).cast("string")))


def _bit(k: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), k.cast("int"))


def _ball(value: Column, radius: int) -> Column:
    """All 32-bit values within radius (at most 2) bits of value."""
    bits = F.sequence(F.lit(0), F.lit(31))
    one = F.transform(bits, lambda i: value.bitwiseXOR(_bit(i)))
    out = F.concat(F.array(value), one)
    if radius == 2:
        two = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(31)), lambda i: F.transform(F.sequence(F.lit(0), i - 1), lambda j: value.bitwiseXOR(_bit(i)).bitwiseXOR(_bit(j)))))
        out = F.concat(out, two)
    return out


def _forest(max_distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out_a, out_b = [], []
            for members in b.column(0):
                left = np.unique(np.array(members.as_py(), np.int64)).view(np.uint64)
                todo: list[int] = []
                while len(left):
                    if not todo:
                        todo, left = [left[0]], left[1:]
                    here = todo.pop()
                    near = np.bitwise_count(left ^ np.uint64(here)) <= max_distance
                    found = left[near]
                    out_a += [here] * len(found)
                    out_b += found.tolist()
                    todo += found.tolist()
                    left = left[~near]
            yield pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (out_a, out_b)], ["a", "b"])

    return run


def hamming_links(fps: DataFrame, max_distance: int = MAX_DISTANCE, group_most: int = GROUP_MOST, hot_rows: int = HOT_ROWS) -> DataFrame:
    """fps: distinct 64-bit values in column fp. Edges (a, b) that connect just what links of max_distance or fewer bits connect."""
    if max_distance > 4:
        raise ValueError("two segments with balls of one bit find distances of 4 bits at most")
    ready_python(fps.sparkSession)
    halves = [F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(LOW))]
    # key: the segment's number above its 32 bits
    keys = F.concat(_ball(halves[0], 1), F.transform(_ball(halves[1], 1), lambda x: x.bitwiseOR(F.lit(1 << 32))))
    # a fingerprint makes 66 rows: few of them a task keep the maps of partial counts small
    fps = fps.repartition(max(1, -(-fps.count() // FPS_A_TASK)), "fp")
    meet = fps.select("fp", F.explode(keys).alias("key"))
    count = meet.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("n > 1")
    count = staged(count, "simhash-keys")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance
    links = count.where("n = 2").where(near).select("a", "b")

    # a filter of a fixed number of bits lets few others of the lookups through to the join with the keys where several meet
    several = count.where("n > 2").select("key", "n")
    slot = F.pmod(F.xxhash64("key"), F.lit(FILTER_BITS))
    bits = several.select(F.floor(slot / 64).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int")).alias("bit"))
    bits = F.broadcast(bits.groupBy("word").agg(F.bit_or("bit").alias("bits")))  # FILTER_BITS / 64 rows at most
    maybe = meet.withColumn("slot", slot).join(bits, F.floor(F.col("slot") / 64) == F.col("word"))
    maybe = maybe.where(F.call_function("shiftright", F.col("bits"), (F.col("slot") % 64).cast("int")).bitwiseAND(F.lit(1)) == 1).select("fp", "key")
    hot_key = hot_of(several.select(key_hash(["key"]).alias("h"), "n"), hot_rows)
    more = staged(join_dealt(maybe, several.withColumnRenamed("key", "at"), {"key": "at"}, hot_key, by=["fp"]).drop("at"), "simhash-groups")
    groups = more.where(F.col("n") <= group_most).groupBy("key").agg(F.collect_list("fp").alias("members"))
    links = links.unionByName(groups.select("members").mapInArrow(_forest(max_distance), "a long, b long"))

    hot = more.where(F.col("n") > group_most)
    if not hot.isEmpty():
        first = F.shiftrightunsigned("key", 32) == 0
        own, other = F.when(first, halves[0]).otherwise(halves[1]), F.when(first, halves[1]).otherwise(halves[0])
        at_key = own == F.col("key").bitwiseAND(F.lit(LOW))
        even = max_distance + max_distance % 2
        wide, slim = even // 2, max(0, even - 2) // 2
        balls = F.when(at_key, _ball(other, 2) if wide == 2 else _ball(other, 1)).otherwise(_ball(other, 1) if slim else F.array(other))
        cells = hot.select("fp", "key", F.explode(balls).alias("z"))
        if even > max_distance:
            members = cells.groupBy("key", "z").agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1)
            return links.unionByName(members.select("members").mapInArrow(_forest(max_distance), "a long, b long")).distinct()
        stars = cells.groupBy("key", "z").agg(F.min("fp").alias("a"), F.count(F.lit(1)).alias("m")).where("m > 1").drop("m")
        star = cells.join(stars, ["key", "z"]).where("fp <> a").select("a", F.col("fp").alias("b"))
        links = links.unionByName(star if max_distance == 4 else star.where(near))
    return links.distinct()


def simhash_classes(rows: DataFrame, max_distance: int = MAX_DISTANCE, group_most: int = GROUP_MOST, hot_rows: int = HOT_ROWS) -> DataFrame:
    """rows (doc_id, fp) -> one row per fingerprint: fp, component_id, keeper (the fingerprint of the row with that id), keepers
    (how many rows have that id and that fingerprint)."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id")
    each = rows.groupBy("fp", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    nodes = staged(each.groupBy("fp").agg(F.min(F.struct(order.alias("o"), "n")).alias("least")), "simhash-nodes")
    label = components(hamming_links(nodes.select("fp"), max_distance, group_most, hot_rows), hot_rows).withColumnRenamed("node", "fp")
    labelled = nodes.join(label, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    labelled = staged(labelled, "simhash-labels")
    heads = labelled.groupBy("component").agg(F.min(F.struct("least.o", "fp", "least.n")).alias("head"))
    found = join_dealt(labelled, heads.withColumnRenamed("component", "at"), {"component": "at"}, hot_keys(labelled, ["component"], hot_rows), by=["fp"])
    return found.select("fp", F.col("head.o.doc_id").alias("component_id"), F.col("head.fp").alias("keeper"), F.col("head.n").alias("keepers"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED, max_distance: int = MAX_DISTANCE, group_most: int = GROUP_MOST, hot_rows: int = HOT_ROWS) -> DataFrame:
    """One row per row of docs: doc_id, fp, component_id (the smallest id that its fingerprint reaches, its own included)."""
    rows = with_fingerprint(docs.select(F.col(name(id_col)).alias("doc_id"), F.col(name(text_col)).alias("text")), "text", "fp", shingle, seed).select("doc_id", "fp")
    rows = staged(rows, "simhash-rows")
    classes = simhash_classes(rows, max_distance, group_most, hot_rows).select(F.col("fp").alias("at"), "component_id")
    return join_dealt(rows, classes, {"fp": "at"}, hot_keys(rows, ["fp"], hot_rows)).drop("at")


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs with one row of each component: the one of smallest id (of rows with that id, any one). The same columns."""
    x, all_columns = own(docs), columns(docs.columns)
    shingle = {k: options.pop(k) for k in ("shingle", "seed") if k in options}
    marked = staged(with_fingerprint(docs, text_col, f"{x}fp", **shingle), "simhash-docs")
    classes = simhash_classes(marked.select(F.col(name(id_col)).alias("doc_id"), F.col(f"{x}fp").alias("fp")), **options)
    heads = classes.where("fp = keeper").select(F.col("component_id").alias(f"{x}id"), F.col("keeper").alias(f"{x}keeper"), F.col("keepers").alias(f"{x}n"))
    on = {f"{x}fp": f"{x}keeper", id_col: f"{x}id"}
    kept = join_dealt(marked, heads, on, hot_keys(marked, list(on), options.get("hot_rows", HOT_ROWS)))
    several = kept.where(F.col(f"{x}n") > 1).groupBy(f"{x}fp").agg(F.min_by(F.struct(*all_columns), F.xxhash64(*all_columns)).alias("one")).select("one.*")
    return kept.where(F.col(f"{x}n") == 1).select(*all_columns).unionByName(several)


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
