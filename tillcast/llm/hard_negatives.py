"""Hard negatives by Four-Russians scoring.

Vectors are whole numbers: floor(scale * x) of each component. An anchor's components are taken in groups of eight; a
table holds the sum of every subset of a group (256 sums). A candidate is stored as bit planes: for each plane (bit of
the two's complement) and group one byte, the index of the subset whose components have that bit. The
inner product is then looked up, plane by plane from the highest: twice what there is, plus the sums that the plane's
bytes select; the sign plane counts negative. These are the full, exact scores, of every anchor with every candidate.

The number of planes follows from the smallest and largest component. Packed candidates are written once and stay where
they are. Anchors come in rounds of at most `round_anchors`, broadcast as numbers; a task makes the tables of
`TABLE_ANCHORS` anchors at a time and keeps the best few of each anchor. Only those few are shuffled and combined.
A first pass finds the positives (same label), a second the negatives (other labels) between `low` and `high` percent of
each positive's score.

Defined results: rows without id or label, without vector, or with a null or non-finite component take no part. Shorter
vectors are filled up with zeros. Identical rows count once; rows that share only their id are different rows, but
no positive of each other. Scores beyond 55 bits are an error. Empty tables give empty tables, as do tables without
anchors.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import map_rows
from tillcast.session import cut_lineage, shared_folder

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
GROUP = 8
TABLE_ANCHORS = 64
ROUND_ANCHORS = 1 << 16
# Candidates scored at a time: few at first, until the best so far keep most others out.
FIRST_ROWS, MOST_ROWS = 64, 2_048


def whole_vectors(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """id, label, q (whole numbers) of the rows of `vectors` (id, label, vector) that take part."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    rows = vectors.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad)
    return rows.select(
        F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
        F.transform("vector", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("q"),
    )


def plan(whole: DataFrame) -> tuple[int, int]:
    """(groups, planes) that hold all components."""
    low, high, size = whole.agg(F.min(F.array_min("q")), F.max(F.array_max("q")), F.max(F.size("q"))).first()
    groups = max(1, -(-(size or 0) // GROUP))
    planes = max(-1 - (low or 0), high or 0, 0).bit_length() + 1
    if (groups * GROUP) * 4 ** (planes - 1) >= 1 << 55:
        raise ValueError("scores need more than 55 bits; choose a smaller scale")
    return groups, planes


def numbers(rows, groups: int) -> np.ndarray:
    """Vectors as a table of whole numbers, filled up with zeros."""
    out = np.zeros((len(rows), groups * GROUP), np.int64)
    sizes = np.fromiter(map(len, rows), np.int64, len(rows))
    if len(rows):
        out[np.arange(out.shape[1]) < sizes[:, None]] = np.concatenate([np.asarray(r, np.int64) for r in rows])
    return out


def bit_planes(table: np.ndarray, planes: int) -> np.ndarray:
    """(row, plane, group) -> byte of the bits that the group's components have in this plane."""
    bits = (table[:, None, :] >> np.arange(planes)[:, None]) & 1
    return np.packbits(bits.astype(np.uint8).reshape(len(table), planes, -1, GROUP), axis=3, bitorder="little")[..., 0]


def subset_sums(anchors: np.ndarray, groups: int, kind) -> np.ndarray:
    """(group, subset, anchor) -> sum of the anchor's components in this subset of the group."""
    parts = anchors.T.reshape(groups, GROUP, -1).astype(kind)
    sums = np.zeros((groups, 1 << GROUP, parts.shape[2]), kind)
    for i in range(GROUP):
        sums[:, 1 << i : 2 << i] = sums[:, : 1 << i] + parts[:, i : i + 1]
    return sums


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidate, anchor) -> inner product, by shifts, additions and lookups."""
    total = np.zeros((len(planes), sums.shape[2]), sums.dtype)
    looked = np.empty_like(total)
    top = planes.shape[1] - 1
    for plane in range(top, -1, -1):
        if plane < top - 1:
            total <<= 1
        elif plane == top - 1:
            total *= -2  # the sign plane
        for group in range(len(sums)):
            np.take(sums[group], planes[:, plane, group], axis=0, out=looked)
            total += looked
    return total if top else -total


def score_type(groups: int, planes: int):
    return np.int32 if groups * GROUP * 4 ** (planes - 1) < 1 << 30 else np.int64


class Best:
    """The `most` best candidates so far of each of many slots: higher scores first, then smaller ids. A pair of id and
    score counts once."""

    def __init__(self, slots: int, most: int):
        self.score = np.full((slots, most), np.iinfo(np.int64).min)
        self.id = np.full((slots, most), np.iinfo(np.int64).max)

    def bar(self, slots) -> np.ndarray:
        """Scores below it cannot enter a slot."""
        return self.score[slots, -1]

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        most, touched = self.score.shape[1], np.unique(slot)
        slot = np.concatenate([np.repeat(touched, most), slot])
        score = np.concatenate([self.score[touched].reshape(-1), score])
        ids = np.concatenate([self.id[touched].reshape(-1), ids])
        order = np.lexsort((ids, ~score, slot))  # ~ turns the order round without an overflow
        slot, score, ids = slot[order], score[order], ids[order]
        empty = np.iinfo(np.int64).min
        again = np.zeros(len(slot), bool)
        again[1:] = (slot[1:] == slot[:-1]) & (score[1:] == score[:-1]) & (ids[1:] == ids[:-1]) & (score[1:] != empty)
        slot, score, ids = slot[~again], score[~again], ids[~again]
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]])
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.r_[first, len(slot)]))
        kept = rank < most
        self.score[slot[kept], rank[kept]] = score[kept]
        self.id[slot[kept], rank[kept]] = ids[kept]

    def rows(self):
        slot, rank = np.nonzero(self.score != np.iinfo(np.int64).min)
        return zip(slot.tolist(), self.score[slot, rank].tolist(), self.id[slot, rank].tolist())


def _scan(packed: DataFrame, anchors, shape: tuple[int, int], most: int, wanted) -> DataFrame:
    """(slot, score, id): the best of every task. `anchors` is a broadcast of (labels, ids, vectors, what `wanted` needs);
    `wanted(labels, ids, part, extra)` returns for some anchors a list of (mask over candidates and anchors,
    lowest, highest score by anchor, slots by anchor)."""
    groups, planes = shape
    kind, make_sums, score_all, best_of = score_type(groups, planes), subset_sums, scores, Best
    block, first_rows, most_rows = TABLE_ANCHORS, FIRST_ROWS, MOST_ROWS

    def run(batches):
        labels, ids, vectors, slots, extra = anchors.value
        best, rows = best_of(slots, most), first_rows
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                part = batch.slice(at, rows)
                at, rows = at + rows, min(2 * rows, most_rows)
                own = part.column(0).to_numpy(), part.column(1).to_numpy()
                bits = np.frombuffer(b"".join(part.column(2).to_pylist()), np.uint8).reshape(-1, planes, groups)
                for start in range(0, len(ids), block):
                    some = slice(start, start + block)
                    found = score_all(make_sums(vectors[some], groups, kind), bits)
                    for mask, low, high, slot in wanted(labels[some], ids[some], own, some, extra):
                        bar = np.maximum(low, best.bar(slot))
                        row, anchor = np.nonzero((found >= bar) & (found <= high) & mask)
                        best.add(slot[anchor], found[row, anchor].astype(np.int64), own[0][row])
        slot, score, found_id = map(list, zip(*best.rows())) if (best.score != np.iinfo(np.int64).min).any() else ([], [], [])
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (slot, score, found_id)], names=["slot", "score", "id"])

    tops = packed.mapInArrow(run, "slot long, score long, id long")
    order = F.array_sort(F.collect_set(F.struct((-F.col("score")).alias("less"), F.col("id").alias("found"))))
    best = tops.groupBy("slot").agg(F.slice(order, 1, most).alias("best"))
    return best.select("slot", F.posexplode("best").alias("rank", "b")).select(
        "slot", (F.col("rank") + 1).alias("rank"), (-F.col("b.less")).alias("score"), F.col("b.found").alias("id")
    )


def _same_label(labels, ids, own, some, extra):
    """All candidates of an anchor's label but itself, one slot an anchor."""
    slot = np.arange(some.start, some.start + len(ids))
    mask = (own[1][:, None] == labels) & (own[0][:, None] != ids)
    least = np.full(len(ids), np.iinfo(np.int64).min)
    return [(mask, least, np.full(len(ids), np.iinfo(np.int64).max), slot)]


def _other_labels(labels, ids, own, some, extra):
    """Candidates of other labels between the bounds of each positive; a slot for each positive."""
    low, high = extra
    mask, positives = own[1][:, None] != labels, low.shape[1]
    slot = np.arange(some.start, some.start + len(ids)) * positives
    return [(mask, low[some, j], high[some, j], slot + j) for j in range(positives)]


def mine(vectors: DataFrame, is_anchor: Column, scale: float = SCALE, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, round_anchors: int = ROUND_ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. `vectors` has id, label, vector;
    `is_anchor` is a condition on id."""
    spark = vectors.sparkSession
    whole = cut_lineage(whole_vectors(vectors, scale))
    groups, planes = shape = plan(whole)

    def make():
        pack, table = bit_planes, numbers
        return lambda ids, labels, q: zip(ids, labels, (row.tobytes() for row in pack(table(q, groups), planes)))

    folder = shared_folder(spark, "bit-planes")
    map_rows(whole, make, batched=True, id="long", label="long", planes="binary").write.parquet(folder)
    packed = spark.read.parquet(folder)
    chosen = whole.filter(is_anchor).distinct()
    rounds = -(-chosen.count() // round_anchors)
    # Dealt row by row, so that rounds are equally large.
    chosen = cut_lineage(chosen.repartition(max(1, rounds)).withColumn("round", F.spark_partition_id()))
    out = None
    for number in range(rounds):
        rows = chosen.filter(F.col("round") == number).toArrow()
        labels, ids = rows.column("label").to_numpy(), rows.column("id").to_numpy()
        table = numbers(rows.column("q").to_pylist(), groups)
        send = spark.sparkContext.broadcast
        tops = _scan(packed, send((labels, ids, table, len(ids), None)), shape, positives, _same_label)
        # At most `positives` rows an anchor of this round.
        found = tops.toArrow()
        slot, rank, score = (found.column(c).to_numpy() for c in ("slot", "rank", "score"))
        nothing = np.iinfo(np.int64).max
        least, top = np.full((len(ids), positives), nothing), np.full((len(ids), positives), -nothing)
        least[slot, rank - 1] = -(-low * score // 100)
        top[slot, rank - 1] = high * score // 100
        hard = _scan(packed, send((labels, ids, table, len(ids) * positives, (least, top))), shape, negatives, _other_labels)
        known = spark.createDataFrame(pa.table({
            "slot": slot * positives + rank - 1, "anchor_id": ids[slot], "positive_id": found.column("id"), "positive_score": score,
        }))
        some = hard.join(known, "slot").select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        out = some if out is None else out.unionByName(some)
    if out is None:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    return out
