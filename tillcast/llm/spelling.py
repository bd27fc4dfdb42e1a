"""Spelling variants: words one edit apart, found by Bloom-guided neighbourhoods.

1. Words. Runs of letters of all documents are counted in their tasks, then over the corpus. `noise` in place of the
   plain run lets a caller change runs before they are counted.
2. Probes. Of each word the deletions and the replacements by a later letter are tried against Bloom filters of the
   vocabulary; insertions and replacements by earlier letters are the same pairs seen from the other word. The
   alphabet is what the vocabulary holds. A word's hash is a polynomial in its code points, so an edit's hash follows from
   the word's by one multiplication and no edited word is spelt out before a filter admits it.
3. Filters. One shard for each length up to LENGTHS (longer words share the last), in blocks of eight 64-bit words with one
   bit of a word in each. They are made by a grouped bit_or and broadcast. A filter has at most `filter_bytes`: a
   larger vocabulary is dealt over rounds by another part of the hash, one filter after the other.
4. Only admitted edits are spelt and shuffled, to an exact join with the vocabulary, which takes out false positives.
5. A word's form is its near word of the largest count, if that is at least `factor` times its own. Counts grow
   along forms, so following them ends; roots are found by doubling the steps, in rounds that grow with the logarithm
   of the longest chain.

Defined results: null and empty texts have no words. Repeated rows count as often as they come; a null doc_id is an empty
text where `noise` asks for it. Words are compared by code points, ties go to the smallest word. Empty tables give
empty tables.
"""

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import map_rows, salted_lookup
from tillcast.session import cut_lineage

LEAST_LENGTH = 5
LEAST_COUNT = 3
FACTOR = 2
NOISE = 97
LETTERS = "[a-zÀ-ÿ]+"  # after lower-casing A-Z
FILTER_BYTES = 32 << 20
BITS = 20  # of a filter for each word
LENGTHS = 64
BLOCK = 8  # 64-bit words
_FLUSH = 500_000
_PROBES = 1 << 18  # tried at a time
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2^64
_BACK = pow(_BASE, -1, 1 << 64)


def typing_noise(doc_id, word: str) -> str:
    """The word without one letter in one of NOISE cases, chosen by a hash of document and word."""
    dice = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
    if dice % NOISE:
        return word
    at = dice % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, noise=None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n: words of at least `least_length` letters that occur at least `least_count` times. A document's equal
    runs are changed alike by `noise(doc_id, run)`."""
    letters, flush = LETTERS, _FLUSH

    def run(batches):
        find, total = re.compile(letters).findall, Counter()

        def out():
            rows = [(w, n) for w, n in total.items() if len(w) >= least_length]
            total.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in rows], pa.string()), pa.array([n for _, n in rows], pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                if not text:
                    continue
                runs = find(text.encode().lower().decode())
                if noise is None:
                    total.update(runs)
                else:
                    for word, n in Counter(runs).items():
                        total[noise(doc_id, word)] += n
                if len(total) > flush:
                    yield out()
        yield out()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """Spreads a polynomial hash over all bits, in place."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        hashes ^= hashes >> np.uint64(shift)
        hashes *= np.uint64(factor)
    hashes ^= hashes >> np.uint64(31)
    return hashes


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row a word."""
    data = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    return data.reshape(len(words), -1).astype(np.uint64)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(codes: np.ndarray) -> np.ndarray:
    return codes @ _powers(codes.shape[1]) if codes.size else np.zeros(len(codes), np.uint64)


def _places(hashes: np.ndarray, blocks: int):
    """(block, bit in the k-th of its words for each k) of mixed hashes."""
    block = ((hashes >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    return block.astype(np.int64), [((hashes >> np.uint64(6 * k)) & np.uint64(63)) for k in range(5)]


class Filters:
    """Blocked Bloom filters by word length: shard -> (first block, blocks), and all their bits. Of several rounds
    a filter holds the words of its own, `part`."""

    def __init__(self, shards: dict[int, tuple[int, int]], part: int, parts: int, bits: np.ndarray | None = None):
        self.shards, self.part, self.parts, self.bits = shards, part, parts, bits

    def masks(self, hashes: np.ndarray, length: int):
        """Block of each mixed hash and, by k, the bit it has in the k-th word of that block."""
        first, blocks = self.shards[min(length, LENGTHS)]
        block, five = _places(hashes, blocks)
        # Three more places from a second mixing of the same hash.
        again = hashes * np.uint64(0xD6E8FEB86659FD93)
        three = [(again >> np.uint64(s)) & np.uint64(63) for s in (58, 50, 42)]
        return block + first, [*five, *three]

    def mine(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes * np.uint64(0xA0761D6478BD642F) >> np.uint64(40)) % np.uint64(self.parts) == self.part

    def admitted(self, hashes: np.ndarray, length: int) -> np.ndarray:
        """Places in `hashes` (mixed, one length) that the filter may hold."""
        if min(length, LENGTHS) not in self.shards:
            return np.empty(0, np.int64)
        left = np.flatnonzero(self.mine(hashes)) if self.parts > 1 else np.arange(len(hashes))
        hashes = hashes[left]
        block, bits = self.masks(hashes, length)
        for k in range(BLOCK):
            hit = np.flatnonzero(self.bits[block, k] >> bits[k] & np.uint64(1))
            left, block, bits = left[hit], block[hit], [b[hit] for b in bits]
        return left


def _by_length(words, *more):
    """Words of one length at a time, each with its values in the lists `more`."""
    groups = {}
    for row in zip(words, *more):
        groups.setdefault(len(row[0]), []).append(row)
    for length, rows in sorted(groups.items()):
        yield length, *map(list, zip(*rows))


def filters(vocabulary: DataFrame, sizes: dict[int, int], part: int = 0, parts: int = 1) -> Filters:
    """The filters of a round. `sizes`: words of each shard."""
    shards, first = {}, 0
    for shard, n in sorted(sizes.items()):
        blocks = -(-n * BITS // (64 * BLOCK * parts))
        shards[shard] = (first, blocks)
        first += blocks
    plan = Filters(shards, part, parts)

    def make():
        def each(words):
            found = {}
            for length, same in _by_length(words):
                hashes = _mixed(word_hashes(_codes(same)))
                hashes = hashes[plan.mine(hashes)]
                block, bits = plan.masks(hashes, length)
                ones = np.stack([np.uint64(1) << b for b in bits], axis=1)
                for at, row in zip(block.tolist(), ones):
                    found[at] = found[at] | row if at in found else row
            return [(at, *row.view(np.int64).tolist()) for at, row in found.items()]

        return each

    names = [f"w{k}" for k in range(BLOCK)]
    rows = map_rows(vocabulary.select("word"), make, batched=True, block="long", **dict.fromkeys(names, "long"))
    table = rows.groupBy("block").agg(*[F.bit_or(w).alias(w) for w in names]).toArrow()
    bits = np.zeros((first, BLOCK), np.uint64)
    at = table.column("block").to_numpy()
    for k, name in enumerate(names):
        bits[at, k] = table.column(name).to_numpy().view(np.uint64)
    return Filters(shards, part, parts, bits)


def _edits(words: list[str], alphabet: np.ndarray, found: Filters):
    """(row, edited word) of words of one length: admitted deletions and replacements by later letters."""
    codes = _codes(words)
    n, length = codes.shape
    power = _powers(length + 1)
    terms = codes * power[:length]
    whole = terms.sum(axis=1, dtype=np.uint64)
    # Without the letter at i, the letters after it move one place down.
    before = np.cumsum(terms, axis=1, dtype=np.uint64) - terms
    hashes = before + (whole[:, None] - before - terms) * np.uint64(_BACK)
    same = np.zeros(codes.shape, bool)
    same[:, :-1] = codes[:, :-1] == codes[:, 1:]  # of equal letters in a row the last one goes
    flat = np.flatnonzero(~same)
    for at in flat[found.admitted(_mixed(hashes.reshape(-1)[flat]), length - 1)].tolist():
        row, i = divmod(at, length)
        yield row, words[row][:i] + words[row][i + 1 :]
    step = max(1, _PROBES // (max(1, n) * max(1, len(alphabet))))
    for start in range(0, length, step):
        part = codes[:, start : start + step]
        hashes = whole[:, None, None] + (alpha := alphabet[None, None, :] - part[:, :, None]) * power[start : start + part.shape[1], None]
        del alpha
        flat = np.flatnonzero(alphabet[None, None, :] > part[:, :, None])
        for at in flat[found.admitted(_mixed(hashes.reshape(-1)[flat]), length)].tolist():
            row, rest = divmod(at, part.shape[1] * len(alphabet))
            i, letter = divmod(rest, len(alphabet))
            yield row, words[row][: start + i] + chr(alphabet[letter]) + words[row][start + i + 1 :]


def probed(vocabulary: DataFrame, found: Filters, alphabet: list[str]) -> DataFrame:
    """word, n, edited: edits of the vocabulary's words that the filters admit."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(found)
    letters = np.array(sorted(map(ord, alphabet)), np.uint64)

    def make():
        bloom, edits, by_length = shared.value, _edits, _by_length

        def each(words, counts):
            for length, same, n in by_length(words, counts):
                # Long words a few at a time, so that their probes stay bounded.
                step = max(1, _PROBES // (length * max(1, len(letters))))
                for at in range(0, len(same), step):
                    for row, edited in edits(same[at : at + step], letters, bloom):
                        yield same[at + row], n[at + row], edited

        return each

    return map_rows(vocabulary.select("word", "n"), make, batched=True, word="string", n="long", edited="string")


def near_words(vocabulary: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, n, near, near_n: every ordered pair of words one edit apart. `vocabulary` (word, n) is read several times."""
    shard = F.least(F.length("word"), F.lit(LENGTHS)).alias("shard")
    sizes = {r.shard: r.n for r in vocabulary.groupBy(shard).agg(F.count(F.lit(1)).alias("n")).collect()}
    letters = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("letter")).filter("letter <> ''")
    alphabet = [r.letter for r in letters.distinct().collect()]
    parts = max(1, -(-sum(sizes.values()) * BITS // (8 * filter_bytes)))
    exact = vocabulary.select(F.col("word").alias("edited"), F.col("n").alias("edited_n"))
    pairs = None
    for part in range(parts):
        bloom = filters(vocabulary, sizes, part, parts)
        some = probed(vocabulary, bloom, alphabet).join(exact, "edited")
        pairs = some if pairs is None else pairs.unionByName(some)
    pairs = cut_lineage(pairs.select("word", "n", F.col("edited").alias("near"), F.col("edited_n").alias("near_n")))
    return pairs.union(pairs.select("near", "near_n", "word", "n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) from (word, form): where following forms ends. Every round doubles the steps taken."""
    steps = cut_lineage(forms.select("word", F.col("form").alias("root")))
    while True:
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("far"))
        moved = cut_lineage(salted_lookup(steps, further, "root"))
        if not moved.filter("far is not null").head(1):
            return steps
        steps = moved.select("word", F.coalesce("far", "root").alias("root"))


def variants(docs: DataFrame, noise=None, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, factor: int = FACTOR,
             filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word."""
    vocabulary = cut_lineage(word_counts(docs, noise, least_length, least_count))
    near = near_words(vocabulary, filter_bytes)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    around = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    large = -F.col("best.less") >= F.lit(factor) * F.col("n")
    formed = cut_lineage(vocabulary.join(around, "word", "left").select(
        "word", F.when(large, F.col("best.near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(large, -F.col("best.less")).alias("form_n"),
    ))
    ends = roots(formed.filter("form is not null"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
