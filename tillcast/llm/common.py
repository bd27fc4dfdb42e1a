"""What the operators share: table reading, Python rows inside Spark tasks, word caches."""

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of the contracts: [\x20\x09-\x0D]. `bytes.split()` cuts at exactly these.
SPACES = " \t\n\x0b\x0c\r"

_ARROW = {
    "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()),
}

# Over how many salts a key's rows are dealt.
SALTS = 32

# Rows of a batch that are Python objects at a time.
SLICE_ROWS = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """`name`, with underscores in front until `df` has no such column (names differ in more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def map_rows(df: DataFrame, make, batched: bool = False, **columns: str) -> DataFrame:
    """Runs Python over the rows of `df` where they lie, without a shuffle. `make()` is called once in a
    task and returns a function from one row's values (batched: from lists of the values of several rows) to
    an iterable of result rows; `columns` names the result's columns and their types."""
    arrow = pa.schema([(name, _ARROW[kind]) for name, kind in columns.items()])
    rows = SLICE_ROWS

    def run(batches):
        each = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                lists = [c.to_pylist() for c in part.columns]
                out = list(each(*lists)) if batched else [r for row in zip(*lists) for r in each(*row)]
                values = zip(*out) if out else [[] for _ in arrow]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(v), f.type) for v, f in zip(values, arrow)], schema=arrow
                )

    return df.mapInArrow(run, ", ".join(f"`{name}` {kind}" for name, kind in columns.items()))


def row_key():
    """Hash of doc_id, source and text: what a decision about a row depends on. Rows of one key have one decision;
    doc_id spreads the copies of a text."""
    parts = [F.col("doc_id").cast("string"), F.col("source").cast("string"), F.col("text")]
    return F.xxhash64(*[part.isNull() for part in parts], *parts)


class WordCache(dict):
    """Remembers `make(word)`. It is emptied when it holds `most` words, so that its memory is bounded;
    results do not depend on it."""

    def __init__(self, make, most: int = 400_000):
        super().__init__()
        self.make, self.most = make, most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        value = self[word] = self.make(word)
        return value


def squeezed(text):
    """The column without any character of SPACES; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    for space in SPACES:
        text = F.replace(text, F.lit(space), F.lit(""))
    return text


def salted_lookup(rows: DataFrame, found: DataFrame, key: str) -> DataFrame:
    """`rows` left-joined with `found`, which has one narrow row a key: a key's rows are dealt over SALTS salts, and `found`
    is repeated for each."""
    salt = fresh(rows, "salt")
    many = found.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return dealt.join(many, [key, salt], "left").drop(salt)
