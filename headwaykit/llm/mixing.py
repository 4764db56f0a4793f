"""Mixing sources to target shares of the total size, with capped repeats and a fair order.

How much of each source: with no total given, the largest total at which no source that has any
documents falls short of its share, so shares are as near their targets as the caps allow; with a
total, sources that run into their cap give all they may and the rest shares what is left in
proportion. Which documents: whole passes over the source and, for the rest, the documents first in a
hash order. In which order: each source's uses fill blocks, block j of a source of weight w may not
run before slot floor(j / w) and must by slot ceil((j + 1) / w), and of the blocks that may run the
one due first runs. At every slot each source is then less than one block from its share. Blocks have a
fixed size, so a large mix has many; they are scheduled in segments, each by itself, whose borders a formula gives.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from headwaykit.llm.tokens import encode_corpus
from headwaykit.session import written


def amounts(sizes: dict[str, int], targets: dict[str, tuple[float, int]], total: float | None = None) -> dict[str, float]:
    """Size to take of each source: sizes once over, targets as (share, max repeats). Sources without size or share take none."""
    live = {s: (w, sizes[s] * r) for s, (w, r) in targets.items() if sizes.get(s, 0) > 0 and w > 0 and r > 0}
    if not live:
        return {s: 0.0 for s in targets}
    weight = sum(w for w, _ in live.values())
    if total is None:
        total = min(cap / (w / weight) for w, cap in live.values())
    taken: dict[str, float] = {}
    rest, left = dict(live), min(total, sum(cap for _, cap in live.values()))
    while rest:
        weight = sum(w for w, _ in rest.values())
        over = {s: cap for s, (w, cap) in rest.items() if cap < left * w / weight - 1e-9}
        if not over:
            taken |= {s: left * w / weight for s, (w, _) in rest.items()}
            break
        taken |= over
        left -= sum(over.values())
        for s in over:
            del rest[s]
    return {s: taken.get(s, 0.0) for s in targets}


def fair_slots(blocks: dict[str, int]) -> dict[str, list[int]]:
    """Slot of each block of each source by earliest deadline among the released ones."""
    total = sum(blocks.values())
    release = [(0, s, 0) for s, n in sorted(blocks.items()) if n]
    heapq.heapify(release)
    ready: list[tuple[int, str, int]] = []
    slots: dict[str, list[int]] = {s: [] for s in blocks}
    for slot in range(total):
        while release and release[0][0] <= slot:
            _, s, j = heapq.heappop(release)
            heapq.heappush(ready, (-(-(j + 1) * total // blocks[s]), s, j))
        _, s, j = heapq.heappop(ready)
        slots[s].append(slot)
        if j + 1 < blocks[s]:
            heapq.heappush(release, ((j + 1) * total // blocks[s], s, j + 1))
    return slots


def segments_of(blocks: int, segment: int) -> int:
    return max(1, -(-blocks // segment))


def before_segment(n: int, i: int, segments: int) -> int:
    """How many of a source's n blocks lie before segment i: i / segments of them, to the nearest."""
    return (2 * i * n + segments) // (2 * segments)


def _schedule(batches: Iterator[pa.RecordBatch], blocks: dict[str, int], segments: int) -> Iterator[pa.RecordBatch]:
    """Segment numbers to (source, block, slot): each segment's blocks by fair_slots, after the slots of those before it."""
    for batch in batches:
        for i in batch.column(0).to_pylist():
            first = {s: before_segment(n, i, segments) for s, n in blocks.items()}
            slots = fair_slots({s: before_segment(n, i + 1, segments) - first[s] for s, n in blocks.items()})
            offset = sum(first.values())
            for s, places in slots.items():
                if places:
                    at = pa.array(range(first[s], first[s] + len(places)), pa.int64())
                    yield pa.RecordBatch.from_arrays([pa.array([s] * len(places), pa.string()), at, pa.array([offset + p for p in places], pa.int64())], names=["source", "_block", "_slot"])


def mix(
    documents: DataFrame,
    targets: DataFrame,
    size: str,
    total: float | None = None,
    block: int = 4_096,
    segment: int = 1 << 16,
    buckets: int = 1_024,
    seed: int = 7,
) -> DataFrame:
    """doc_id, source, size, uses, slots, target_share, actual_share: one row per document.

    documents: doc_id, source and `size` (a long). targets: source, target_share, max_repeats, one row
    per source, at most 10,000 rows (they are planned on the driver). Documents with a null source, or
    one without target, have 0 uses and null shares. slots has, for each use, the place of its block in
    the order. Up to `segment` blocks in all, each source is at every slot less than one block from its share; of
    more, it is so from the line between its segment's borders, where it is at most half a block and half a
    slot per source off. Documents of size 0 cost nothing and are used as often as the passes over their source
    go. A source's size taken is within one document of its amount. Rows given twice are rows of their own.
    An empty table gives no rows.
    """
    wanted = targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))
    rows = wanted.limit(10_001).collect()
    if len(rows) > 10_000:
        raise ValueError("more than 10,000 targets")
    plan = {r["source"]: (float(r["target_share"] or 0), int(r["max_repeats"] or 0)) for r in rows}
    spread = F.pmod(F.xxhash64(F.lit(seed), F.col("doc_id")), F.lit(2**40)).alias("_order")
    base = documents.select("doc_id", "source", F.coalesce(F.col(size), F.lit(0)).cast("long").alias("size"), spread)
    base = base.withColumn("_bucket", F.floor(F.col("_order") * buckets / F.lit(2**40)).cast("int"))
    per_bucket = base.where(F.col("source").isin(list(plan))).groupBy("source", "_bucket").agg(F.sum("size").alias("_size"))
    sizes = {r["source"]: int(r["s"]) for r in per_bucket.groupBy("source").agg(F.sum("_size").alias("s")).collect()}
    take = amounts(sizes, plan, total)
    spark = documents.sparkSession
    blocks = {s: -(-int(a + 0.5) // block) for s, a in take.items()}
    segments = segments_of(sum(blocks.values()), segment)
    slots = spark.range(segments).repartition(min(segments, 4096)).mapInArrow(partial(_schedule, blocks=blocks, segments=segments), "source string, _block long, _slot long")
    passes = {s: min(plan[s][1], int(take[s] // sizes[s])) if sizes.get(s) else 0 for s in plan}
    facts = spark.createDataFrame(
        [(s, plan[s][0], sizes.get(s, 0), passes[s], take[s] - passes[s] * sizes.get(s, 0) if passes[s] < plan[s][1] else 0.0) for s in plan],
        "source string, target_share double, _total long, _passes int, _rest double",
    )
    offsets = per_bucket.withColumn("_before", F.sum("_size").over(Window.partitionBy("source").orderBy("_bucket")) - F.col("_size")).drop("_size")
    inside = Window.partitionBy("source", "_bucket").orderBy("_order", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        base.where(F.col("source").isin(list(plan)))
        .join(offsets, ["source", "_bucket"])
        .join(F.broadcast(facts), "source")  # at most 10,000 rows
        .withColumn("_at", F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .withColumn("_extra", (F.col("_at") + F.col("size") / 2.0 < F.col("_rest")).cast("int"))
        .withColumn("uses", F.col("_passes") + F.col("_extra"))
    )
    shared = placed.groupBy("source").agg(F.sum(F.col("uses") * F.col("size")).alias("_used"))
    whole = F.sum("_used").over(Window.partitionBy(F.lit(1)))  # over a row per target
    shares = shared.select("source", F.try_divide("_used", whole).alias("actual_share"))
    # A row per use meets its block's slot; a row per document and use count comes back.
    row = ["_row", "doc_id", "source", "size", "uses", "target_share"]
    numbered = placed.withColumn("_row", F.monotonically_increasing_id())
    counts = spark.createDataFrame(list(blocks.items()), "source string, _blocks long")
    each = numbered.withColumn("_use", F.explode_outer(F.when(F.col("uses") > 0, F.sequence(F.lit(0), F.col("uses") - 1)))).join(F.broadcast(counts), "source")  # a row per target
    at = F.least(F.floor((F.col("_use") * F.col("_total") + F.col("_at")) / F.lit(block)).cast("long"), F.col("_blocks") - 1)
    met = each.withColumn("_block", at).join(slots, ["source", "_block"], "left")
    use = F.when(F.col("_use").isNotNull(), F.struct("_use", "_slot"))
    known = (
        met.groupBy(*row).agg(F.transform(F.sort_array(F.collect_list(use)), lambda u: u["_slot"]).alias("slots"))  # max_repeats at most
        .join(F.broadcast(shares), "source", "left")  # a row per target
        .select("doc_id", "source", "size", "uses", "slots", "target_share", "actual_share")
    )
    other = base.where(~F.coalesce(F.col("source").isin(list(plan)), F.lit(False))).select(
        "doc_id", "source", "size", F.lit(0).alias("uses"), F.array().cast("array<bigint>").alias("slots"),
        F.lit(None).cast("double").alias("target_share"), F.lit(None).cast("double").alias("actual_share"),
    )
    return known.unionByName(other)


def targeted_size(documents: DataFrame, targets: DataFrame, size: str) -> int:
    """Size once over of all documents whose source has a target: the total that asks for the whole corpus."""
    wanted = targets.where("source is not null").select("source").distinct()
    return documents.join(wanted, "source", "left_semi").agg(F.coalesce(F.sum(size), F.lit(0)).cast("long")).first()[0]


def counted(documents: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, source, size in tokens; written to the checkpoint folder, since the mix reads it several times."""
    keyed = documents.select(F.struct("doc_id", "source").alias("_id"), "text")
    tokens = encode_corpus(keyed, "_id", vocabulary=vocabulary, counts=True)
    return written(tokens.select("_id.doc_id", "_id.source", F.col("ids").alias("size")), "counts")
