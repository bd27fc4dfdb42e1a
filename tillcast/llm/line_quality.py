"""Quality rules with cross-document line frequencies.

Base rules look at a document alone. The method then hashes every normalised line (lower case, digits as
0, single spaces), counts in how many documents of its host (`source`) a line occurs, takes lines above
the host's limit for boilerplate, and rejects documents that are depleted without them.

A limit is the larger of `least` documents and `share` of the host's documents. Both counts take different
documents, that is doc_ids; with `distinct_texts` they take documents of one text once, for a caller that removes
copies afterwards and needs one of a large group to get that far. Lines of every length count. A document is depleted
if less than `keep_share` of its words remain.

Defined results: a null text has no words and fails the base rules. A null source is a host of its own. A row
without doc_id is a document of its own; rows of one doc_id are one. Repeated rows are returned as often as they come.
Empty tables give empty tables.
"""

from collections import Counter

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import fresh, map_rows, row_key
from tillcast.session import cut_lineage

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
LEAST = 20
SHARE = 0.02
KEEP_SHARE = 0.5
SYMBOLS = "#*$%&|<>"
_ZERO_DIGITS = bytes.maketrans(b"123456789", b"000000000")


def line_key(words: list[bytes]) -> int:
    """Hash of a line's words after normalising, signed."""
    line = b" ".join(words).decode().lower().encode().translate(_ZERO_DIGITS)
    return int.from_bytes(xxhash.xxh64_digest(line), "big", signed=True)


def repeated_words(words: list[bytes]) -> int:
    """Words covered by 3-word windows that occur twice or more."""
    windows = list(zip(words, words[1:], words[2:]))
    times = Counter(windows)
    if len(times) == len(windows):
        return 0
    covered, until = 0, 0
    for at, window in enumerate(windows):
        if times[window] > 1:
            covered += at + 3 - max(at, until)
            until = at + 3
    return covered


def measure(text: str | None):
    """Counts of a text, and its different lines (hash, words in all its occurrences)."""
    text = text or ""
    data = text.encode()
    words = data.split()
    word_chars = len(text) - (len(data) - sum(map(len, words)))
    seen, dup_lines, lines = set(), 0, {}
    for line in data.split(b"\n"):
        inside = line.split()
        if not inside:
            continue
        if line in seen:
            dup_lines += 1
        seen.add(line)
        key = line_key(inside)
        lines[key] = lines.get(key, 0) + len(inside)
    n_symbols = sum(map(text.count, SYMBOLS))
    return (len(words), word_chars, n_symbols, dup_lines, repeated_words(words),
            xxhash.xxh64_intdigest(data, 1) - (1 << 63), list(lines), list(lines.values()))


def measures(docs: DataFrame) -> DataFrame:
    """The counts and lines of every row, under a row number `row`, evaluated once."""

    def make():
        count = measure
        return lambda doc_id, source, key, text: ((doc_id, source, key, *count(text)),)

    rows = map_rows(
        docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), row_key().alias("row_key"), "text"), make,
        doc_id="long", source="string", row_key="long", n_words="long", word_chars="long", n_symbols="long", n_dup_lines="long",
        n_repeat_words="long", text_hash="long", line_keys="array<long>", line_words="array<long>",
    )
    return cut_lineage(rows.withColumn("row", F.monotonically_increasing_id()))


def boilerplate(measured: DataFrame, least: int = LEAST, share: float = SHARE, distinct_texts: bool = False) -> DataFrame:
    """(source, line, documents): lines above their host's limit."""
    one = ["text_hash"] if distinct_texts else ["doc_id", F.when(F.col("doc_id").isNull(), F.col("row")).alias("no_id")]
    hosts = measured.select("source", *one).distinct().groupBy("source").agg(
        F.greatest(F.lit(float(least)), F.count(F.lit(1)) * F.lit(share)).alias("limit")
    )
    return (
        measured.select("source", *one, F.explode("line_keys").alias("line")).distinct()
        .groupBy("source", "line").agg(F.count(F.lit(1)).alias("documents")).filter(F.col("documents") > least)
        .join(hosts.withColumnRenamed("source", "host"), F.col("source").eqNullSafe(F.col("host")))
        .filter("documents > limit").select("source", "line", "documents")
    )


def quality_rules(docs: DataFrame, least: int = LEAST, share: float = SHARE,
                  keep_share: float = KEEP_SHARE, distinct_texts: bool = False) -> DataFrame:
    """One row per document: the base counts, base_failed, boilerplate words, kept."""
    return _judged(docs, least, share, keep_share, distinct_texts).drop("row_key")


def _judged(docs: DataFrame, least: int = LEAST, share: float = SHARE, keep_share: float = KEEP_SHARE,
            distinct_texts: bool = False) -> DataFrame:
    measured = measures(docs)
    lines = cut_lineage(boilerplate(measured, least, share, distinct_texts))
    common = lines.select(F.col("source").alias("host"), "line")
    held = measured.select(
        "row", "source", F.explode(F.arrays_zip("line_keys", "line_words")).alias("l")
    ).select("row", "source", F.col("l.line_keys").alias("line"), F.col("l.line_words").alias("words"))
    removed = (
        held.join(common, (held.line == common.line) & held.source.eqNullSafe(common.host))
        .groupBy("row").agg(F.sum("words").alias("n_boilerplate_words"))
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    cut = F.coalesce("n_boilerplate_words", F.lit(0)).cast("long")
    depleted = F.col("n_words") - cut < keep_share * F.col("n_words")
    return measured.join(removed, "row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), cut.alias("n_boilerplate_words"), (~failed & ~depleted).alias("kept"), "row_key",
    )


def without_boilerplate(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """`docs` with the text's boilerplate lines removed; `lines` as `boilerplate` returns them."""
    row, place = fresh(docs, "row"), fresh(docs, "line_no")
    numbered = cut_lineage(docs.withColumn(row, F.monotonically_increasing_id()))

    def make():
        key = line_key

        def each(number, source, text):
            for at, line in enumerate((text or "").split("\n")):
                words = line.encode().split()
                yield number, source, at, key(words) if words else None, line

        return each

    split = map_rows(
        numbered.select(row, F.col("source").cast("string"), "text"), make,
        r="long", host="string", at="long", key="long", line="string",
    )
    rules = lines.select(F.col("source").alias("rule_host"), F.col("line").alias("rule"))
    rest = split.join(rules, (split.key == rules.rule) & split.host.eqNullSafe(rules.rule_host), "left_anti")
    texts = rest.groupBy("r").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n").alias(place)
    )
    back = numbered.join(texts.withColumnRenamed("r", row), row, "left")
    return back.select(*[F.coalesce(place, F.lit("")).alias(c) if c == "text" else F.col(c) for c in docs.columns])


def keep_documents(docs: DataFrame, **limits) -> DataFrame:
    """The rows of `docs` that the rules keep, unchanged, each by its own text and host, with or without doc_id."""
    key = fresh(docs, "row_key")
    kept = _judged(docs, **limits).filter("kept").select(F.col("row_key").alias(key))
    return docs.withColumn(key, row_key()).join(kept, key, "left_semi").select(*docs.columns)
