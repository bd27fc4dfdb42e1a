"""SimHash near-duplicates: a byte-position inverted index with count filtering.

A fingerprint has eight bytes, each a posting (position, byte). Two fingerprints at `MAX_BITS` = 2 or fewer
differing bits differ in two bytes at most, so they share at least six postings. The lists of single
bytes would hold 1/256 of all fingerprints each, so the index lists *four* positions together: of the
four byte pairs two at least are untouched, hence each link shares one of the six lists made of two byte
pairs. Pairs of a list are counted (how many of the eight positional bytes they share), those with six or
more are verified bit by bit.

Lists longer than `long_list` are not paired: there each fingerprint also posts the 32 variants with one
of the bits outside the list flipped. Two fingerprints are at distance two or less exactly if they share
a variant, so linking the holders of a variant to the smallest of them keeps every connection with 33
rows a fingerprint instead of all pairs.

Defined results: a null or wordless text has fingerprint zero and is linked like any other. Repeated rows are
returned as often as they come and link through their fingerprint. Rows without doc_id keep a null
component unless they share a fingerprint or link with others. Empty tables give empty tables.
"""

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import fresh, map_rows
from tillcast.llm.components import components
from tillcast.session import cut_lineage

MAX_BITS = 2
LONG_LIST = 64
SHINGLE_WORDS = 3
SEED = 42
_CHUNK = 1 << 16


def _hasher(size: int = SHINGLE_WORDS, seed: int = SEED):
    """Function from a text to its 64-bit fingerprint as a signed number."""
    digest = xxhash.xxh64_intdigest

    def fingerprint(text):
        words = (text or "").encode().lower().split()
        if not words:
            return 0
        shingles = [b" ".join(words)]
        if len(words) >= size:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(size))))
        hashes = np.array([digest(s, seed) for s in shingles], dtype=np.uint64).byteswap()
        ones = np.zeros(64, dtype=np.int64)
        for at in range(0, len(hashes), _CHUNK):
            part = hashes[at : at + _CHUNK]
            ones += np.unpackbits(part.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
        return int.from_bytes(np.packbits(ones * 2 > len(hashes)).tobytes(), "big", signed=True)

    return fingerprint


def fingerprints(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id and `fp`, the fingerprint as a signed number, of every whole text."""

    def make():
        fingerprint = _hasher(size)
        return lambda doc_id, text: ((doc_id, fingerprint(text)),)

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), make, doc_id="long", fp="long")


def _pair_of_bytes(fp: Column, place: int) -> Column:
    return F.shiftrightunsigned(fp, 16 * place).bitwiseAND(F.lit(0xFFFF))


def shared_bytes(a: Column, b: Column) -> Column:
    """How many of the eight positional bytes are equal."""
    differ = a.bitwiseXOR(b)
    same = [(F.shiftrightunsigned(differ, 8 * p).bitwiseAND(F.lit(0xFF)) == 0).cast("int") for p in range(8)]
    return sum(same[1:], same[0])


def _postings(classes: DataFrame) -> DataFrame:
    """fp, list: each fingerprint on its six lists."""
    fp = F.col("fp")
    lists = [
        F.struct(F.lit(n).alias("place"), F.shiftleft(_pair_of_bytes(fp, i), 16).bitwiseOR(_pair_of_bytes(fp, j)).alias("bytes"))
        for n, (i, j) in enumerate(combinations(range(4), 2))
    ]
    return classes.select("fp", F.explode(F.array(*lists)).alias("l")).select("fp", "l.place", "l.bytes")


def fingerprint_links(classes: DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """(a, b): links between different fingerprints (column fp, distinct) that connect exactly those that
    all pairs at MAX_BITS or fewer differing bits connect."""
    postings = _postings(classes)
    sizes = postings.groupBy("place", "bytes").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    shared = cut_lineage(postings.join(sizes, ["place", "bytes"]))
    short = shared.filter(F.col("held") <= long_list).select("place", "bytes", "fp")
    pairs = (
        short.withColumnRenamed("fp", "a").join(short.withColumnRenamed("fp", "b"), ["place", "bytes"])
        .filter("a < b")
        .filter(shared_bytes(F.col("a"), F.col("b")) >= 8 - MAX_BITS)
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_BITS)
        .select("a", "b")
    )
    return pairs.union(_stars(shared.filter(F.col("held") > long_list))).distinct()


def _stars(crowded: DataFrame) -> DataFrame:
    """Links of the long lists through variants with one bit outside the list flipped."""
    free = [[p for p in range(4) if p not in pair] for pair in combinations(range(4), 2)]
    flips = F.array(*[
        F.array(*[F.lit(1 << b if b < 63 else -(1 << 63)).cast("long") for p in places for b in range(16 * p, 16 * p + 16)])
        for places in free
    ])
    variants = crowded.select(
        "place", "bytes", "fp",
        F.explode(F.concat(F.array(F.lit(0).cast("long")), F.element_at(flips, F.col("place") + 1))).alias("flip"),
    ).select("place", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("variant"))
    least = variants.groupBy("place", "variant").agg(F.min("fp").alias("low"), F.count(F.lit(1)).alias("held"))
    return variants.join(least.filter("held > 1"), ["place", "variant"]).filter("fp <> low").select(
        F.col("fp").alias("a"), F.col("low").alias("b")
    )


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, long_list: int = LONG_LIST) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: the smallest doc_id that links reach."""
    prints = cut_lineage(fingerprints(docs, size))
    classes = cut_lineage(prints.groupBy("fp").agg(F.min("doc_id").alias("low_id")))
    links = fingerprint_links(classes.select("fp"), long_list)
    # Roots are the smallest fingerprints; the smallest doc_id of the component follows from its members.
    labels = components(links)
    members = labels.union(labels.select("component", "component").distinct()).toDF("fp", "root")
    roots = cut_lineage(members.join(classes, "fp"))
    lowest = roots.groupBy("root").agg(F.min("low_id").alias("component_id"))
    linked = roots.select("fp", "root").join(lowest, "root").select("fp", "component_id")
    # Fingerprints of one document need no row here: that document is its own component.
    copies = prints.groupBy("fp").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low_id")).filter("n > 1")
    known = copies.select("fp", "low_id").join(linked, "fp", "full").select(
        "fp", F.coalesce("component_id", "low_id").alias("component_id")
    )
    return prints.join(known, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def deduplicate(docs: DataFrame, size: int = SHINGLE_WORDS) -> DataFrame:
    """The rows of `docs` whose doc_id is the smallest of its component, one for each doc_id. Rows without
    doc_id stay, since nothing tells them apart."""
    kept = near_duplicates(docs, size).filter("doc_id = component_id").select("doc_id")
    place, longest = fresh(docs, "near_place"), F.length("text").desc_nulls_last()
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy(longest, F.xxhash64("text")))
    single = docs.join(kept, "doc_id", "left_semi").withColumn(place, first).filter(F.col(place) == 1)
    return single.select(*docs.columns).union(docs.filter("doc_id is null").select(*docs.columns))
