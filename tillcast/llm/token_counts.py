"""Token counts: an exact length histogram answers every context limit.

Documents are encoded once and counted by (source, encoded length). The histogram has a row for each
length that occurs, whatever the number of documents, and suffix sums over it give, for every limit L that is a
length of the histogram: documents and tokens in texts of L or more, tokens that remain if longer texts are cut at L,
and the share of documents of at most L, from which quantiles are read. Suffix sums run in two levels
(inside blocks of lengths, then over block totals), so no task holds a whole histogram.

Defined results: a null or empty text has 0 tokens and counts. Null sources are a source of their own. Repeated
rows count as often as they come. An empty table gives an empty histogram; its quantiles are no rows.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import WordCache, map_rows
from tillcast.session import cut_lineage

BLOCK = 1024
ALL = "(all)"


def tokenizer_file(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read_ranks(path: str) -> dict[bytes, int]:
    import base64

    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def token_counter(ranks: dict[bytes, int], pattern: str):
    """Function from a text to its number of ids. The pattern cuts before each single space between two
    other characters, so a text without double white space has the ids of its words with their spaces."""
    import re

    import tiktoken

    encode = tiktoken.Encoding("file", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    counts = WordCache(lambda word: len(encode(" " + word)))
    mixed = re.compile(r"^\s|\s$|\s\s").search

    def count(text):
        if not text or mixed(text):
            return len(encode(text or ""))
        first, _, rest = text.partition(" ")
        return len(encode(first)) + (sum(map(counts.__getitem__, rest.split(" "))) if rest else 0)

    return count


def document_tokens(docs: DataFrame, tokenizer: str | None = None, pattern: str | None = None) -> DataFrame:
    """doc_id, source and n_tokens of every whole text. `tokenizer`: path of a ranks file."""
    if pattern is None:
        from public_tokenizers import PATTERN as pattern
    shared = docs.sparkSession.sparkContext.broadcast(_read_ranks(tokenizer or tokenizer_file()))

    def make():
        count = token_counter(shared.value, pattern)
        return lambda doc_id, source, text: ((doc_id, source, count(text)),)

    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), "text")
    return map_rows(rows, make, doc_id="long", source="string", n_tokens="long")


def length_histogram(counted: DataFrame) -> DataFrame:
    """(source, n_tokens, documents), and the same over all sources under ALL; `is_all` tells them apart."""
    own = counted.groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("documents"))
    both = F.array(F.struct(F.lit(False).alias("is_all"), F.col("source")), F.struct(F.lit(True).alias("is_all"), F.lit(ALL).alias("source")))
    return own.select(F.explode(both).alias("s"), "n_tokens", "documents").groupBy("s.is_all", "s.source", "n_tokens").agg(
        F.sum("documents").alias("documents")
    )


def limit_table(histogram: DataFrame) -> DataFrame:
    """What each length means as a context limit, by suffix sums."""
    key = ["is_all", "source"]
    rows = histogram.withColumn("block", F.floor(F.col("n_tokens") / BLOCK)).withColumn(
        "tokens", F.col("documents") * F.col("n_tokens")
    )
    sums = rows.groupBy(*key, "block").agg(F.sum("documents").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    above = Window.partitionBy(*key).orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    whole = Window.partitionBy(*key)
    later = sums.select(
        F.col("is_all").alias("k_all"), F.col("source").alias("k_source"), F.col("block").alias("k_block"),
        F.coalesce(F.sum("b_docs").over(above), F.lit(0)).alias("docs_above"),
        F.coalesce(F.sum("b_tokens").over(above), F.lit(0)).alias("tokens_above"),
        F.sum("b_docs").over(whole).alias("total_documents"), F.sum("b_tokens").over(whole).alias("total_tokens"),
    )
    same = (
        (F.col("is_all") == F.col("k_all")) & F.col("source").eqNullSafe(F.col("k_source")) & (F.col("block") == F.col("k_block"))
    )
    inside = Window.partitionBy(*key, "block").orderBy("n_tokens").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    limit = F.col("n_tokens")
    return (
        rows.withColumn("docs_in", F.sum("documents").over(inside)).withColumn("tokens_in", F.sum("tokens").over(inside))
        .join(later, same)
        .select(
            *key, "n_tokens", "documents",
            (F.col("docs_in") + F.col("docs_above")).alias("documents_from"),
            (F.col("tokens_in") + F.col("tokens_above")).alias("tokens_from"),
            "total_documents", "total_tokens",
        )
        # Cut at this length, texts of it or more keep `limit` tokens and shorter ones all.
        .withColumn("truncated_tokens", F.col("total_tokens") - F.col("tokens_from") + limit * F.col("documents_from"))
        .withColumn("share_at_most", F.round(
            (F.col("total_documents") - F.col("documents_from") + F.col("documents")) / F.col("total_documents"), 12
        ))
    )


def quantiles(limits: DataFrame, shares=(0.5, 0.9, 0.95, 0.99, 1.0)) -> DataFrame:
    """(is_all, source, share, n_tokens): the smallest length that holds at least `share` of the documents."""
    wanted = F.explode(F.array(*[F.lit(float(s)) for s in shares])).alias("share")
    return limits.select("*", wanted).filter(F.col("share_at_most") >= F.col("share") - 1e-12).groupBy(
        "is_all", "source", "share"
    ).agg(F.min("n_tokens").alias("n_tokens"))


def truncated_total(limits: DataFrame, limit: int) -> DataFrame:
    """(is_all, source, tokens): total if texts are cut at any `limit`, in the histogram or not."""
    longer = F.col("n_tokens") > limit
    tokens = F.when(longer, F.col("documents") * limit).otherwise(F.col("documents") * F.col("n_tokens"))
    return limits.groupBy("is_all", "source").agg(F.sum(tokens).alias("tokens"))


def token_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    # Sums inside blocks and over them read the histogram twice; encoding is done once.
    return limit_table(cut_lineage(length_histogram(document_tokens(docs, tokenizer))))
