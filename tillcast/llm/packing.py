"""Best-fit packing of tokenised documents under several capacities.

A document becomes its token ids and an end id; longer ones are cut into pieces of the sequence length. Pieces
are dealt at random over shards of about `shard_pieces` pieces, so that all shards see the same lengths and
each wastes at most its last sequences. In a shard, pieces are placed largest first. A bin has three
residual capacities, each as a share of the whole: tokens, documents and attention cost (the sum
of squared lengths). Of the bins that can take a piece under every capacity, `fit` selects the one with

    "dot"    the largest weighted dot product of residual and demand
    "norm"   the smallest weighted norm of what would remain

and "fewest" (the default) packs a shard both ways and keeps the one with fewer bins.

Defined results: a null or empty text is one piece that holds the end id alone. Repeated rows are pieces of
their own. Empty tables give empty tables. `doc_id` is returned as it comes, null included.
"""

import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.session import cut_lineage

LENGTH = 2048
END_ID = 0
MAX_DOCUMENTS = 512
WEIGHTS = (1.0, 0.05, 0.05)
SHARD_PIECES = 16_000
# Bytes of text whose words are looked up together.
RUN_BYTES = 8_000_000


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _read(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def _strings(array: pa.Array) -> list[str]:
    return array.to_numpy(zero_copy_only=False).tolist()


class WordIds:
    """Token ids of words. Words of letters are encoded many at a time, and capitals and closing punctuation do not
    make an ASCII word new: this tokenizer lowers case and always cuts between a letter and a sign. Words are
    kept in two generations of at least `most` words: when the younger one has that many the older one goes, and
    words in use move over."""

    SIGNS = ".,;:!?*#$%&"

    def __init__(self, tokenizer, most: int = 400_000):
        self.tokenizer, self.most = tokenizer, most
        self.known, self.older = {}, {}  # word -> ids as little-endian 32-bit numbers
        vocabulary = tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _ids(self, text):
        found = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.array(found, dtype="<u4")

    def _add_letters(self, words):
        """Each of these words is one token group, whose last id is marked as a word's end."""
        ids = self._ids(" ".join(words))
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(words):
            data = ids.tobytes()
            bounds = (4 * stops).tolist()
            self.known.update(zip(words, map(data.__getitem__, map(slice, [0, *bounds[:-1]], bounds))))
        else:
            for word in words:
                self.known[word] = self._ids(word).tobytes()

    def _new(self, words):
        """Those of these different words that neither generation has; words of the older one move over."""
        known, older = self.known, self.older
        new = [word for word in words if word not in known]
        if older:
            known.update([(word, older[word]) for word in new if word in older])
            new = [word for word in new if word not in known]
        return new

    def _add(self, words):
        words = pa.array(words, pa.string())
        stems = pc.utf8_rtrim(words, characters=self.SIGNS)
        last = pc.utf8_slice_codeunits(stems, -1)
        # Beyond Latin, or as in "\u0130", normalising can end a letter in a mark that joins the signs.
        plain = [c for c in last.unique().to_pylist() if c and c < "\u0250" and c.lower().isalpha()]
        cut = pc.and_(pc.is_in(last, pa.array(plain, pa.string())), pc.not_equal(stems, words))
        cut = pc.and_not(cut, pc.match_substring(stems, "<"))
        signed, bare = _strings(words.filter(cut)), _strings(stems.filter(cut))
        signs = [text[len(stem):] for text, stem in zip(signed, bare)]
        new = self._new(_strings(pc.if_else(cut, stems, words).unique()))
        letters = [text for text in new if text.isalpha()]
        if letters:
            self._add_letters(letters)
        known = self.known
        for text in self._new({*new, *signs}.difference(letters)):
            known[text] = self._ids(text).tobytes() if text else b""
        for text, stem, sign in zip(signed, bare, signs):
            known[text] = known[stem] + known[sign]

    def of(self, texts: pa.Array):
        """(ids of all these texts, where each text's end). This tokenizer drops white space and no token, special or
        not, spans it, so the ids of a text are those of its parts between spaces. Only special tokens depend on
        case. Each different word is looked up once, the ids are put together by their places."""
        texts = pc.fill_null(texts, "")
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        parts = pc.ascii_split_whitespace(texts)
        counts = parts.value_lengths().to_numpy(zero_copy_only=False)
        coded = parts.flatten().dictionary_encode()
        words, place = _strings(coded.dictionary), coded.indices.to_numpy()
        if len(self.known) > self.most:
            self.known, self.older = {}, self.known
        new = self._new(words)
        if new:
            self._add(new)
        ids = list(map(self.known.__getitem__, words))
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        start = np.cumsum(size) - size
        sizes = size[place]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(start[place] - ends + sizes, sizes) + np.arange(total)
        flat = np.frombuffer(b"".join(ids), "<u4")[at]
        return flat, np.concatenate([[0], ends])[np.cumsum(counts)]


class SharedEncoder:
    """Word ids for a broadcast. A Python worker keeps what it got by broadcast from task to task, so it reads
    the vocabulary once and its words stay known. Only the tokenizer file travels."""

    def __init__(self, model: bytes):
        self.model, self.made = model, None

    def __getstate__(self):
        return self.model

    def __setstate__(self, model):
        self.__init__(model)

    def word_ids(self) -> WordIds:
        if self.made is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer

            self.made = WordIds(Tokenizer.from_buffer(self.model))
        return self.made


def _runs(batch: pa.RecordBatch, most: int = RUN_BYTES):
    """Slices of a batch whose texts (second column) have about `most` bytes, or one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        until = max(at + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(at, until - at)
        at = until


def _cut(docs: DataFrame, model: bytes, length: int, end_id: int, last: str, kind: pa.DataType, make) -> DataFrame:
    """doc_id, piece, start, length of every piece, and column `last`: `make` of the piece's ids."""
    shared = docs.sparkSession.sparkContext.broadcast(SharedEncoder(model))
    fields = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), last: kind}
    runs = _runs

    def run(batches):
        words = shared.value.word_ids()
        for batch in batches:
            for part in runs(batch):
                flat, ends = words.of(part.column(1))
                flat, ends = np.insert(flat, ends, end_id), ends + np.arange(1, len(ends) + 1)
                sizes = np.diff(ends, prepend=0)
                counts = -(-sizes // length)
                row = np.repeat(np.arange(len(ends)), counts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                start = piece * length
                held = np.minimum(sizes[row] - start, length)
                begin = (ends - sizes)[row] + start
                made = [make(flat[a:b]) for a, b in zip(begin.tolist(), (begin + held).tolist())]
                columns = [part.column(0).take(pa.array(row)), piece.astype(np.int32), start, held, made]
                yield pa.RecordBatch.from_arrays(
                    [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, fields.values())], names=list(fields)
                )

    names = {pa.int64(): "long", pa.int32(): "int"}
    ddl = ", ".join(f"`{name}` {names.get(t, 'array<int>')}" for name, t in fields.items())
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ddl)


def pieces(docs: DataFrame, model: bytes, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every piece."""
    return _cut(docs, model, length, end_id, "ids_crc32", pa.int64(), lambda ids: zlib.crc32(ids.tobytes()))


def vector_best_fit(lengths: np.ndarray, capacity: np.ndarray, weights: np.ndarray, fit: str):
    """(bin, offset) of every piece. Bins that cannot take even the shortest piece are closed."""
    order = np.argsort(-lengths, kind="stable")
    demands = np.stack([lengths, np.ones_like(lengths), lengths * lengths], axis=1) / capacity
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    rest = np.empty((len(lengths), 3))  # residual shares of the open bins
    number, filled = np.empty(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    smallest = demands[order[-1]] if len(order) else None
    opened = live = 0
    slack = 1e-12
    for at in order:
        demand, at_bin = demands[at], -1
        room = rest[:live]
        fits = np.flatnonzero((room >= demand - slack).all(axis=1))
        if len(fits):
            if fit == "dot":
                best = fits[np.argmax((room[fits] * demand) @ weights)]
            else:
                left = room[fits] - demand
                best = fits[np.argmin((left * left) @ weights)]
            at_bin = int(best)
        else:
            at_bin = live
            rest[live], number[live], filled[live] = 1.0, opened, 0
            live, opened = live + 1, opened + 1
        bins[at], offsets[at] = number[at_bin], filled[at_bin]
        rest[at_bin] -= demand
        filled[at_bin] += lengths[at]
        if (rest[at_bin] < smallest - slack).any():  # closed: the last open bin takes its place
            live -= 1
            rest[at_bin], number[at_bin], filled[at_bin] = rest[live], number[live], filled[live]
    return bins, offsets, opened


def _pack_shard(capacity, weights, fit):
    def pack(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "row"], ascending=[False, True], ignore_index=True)
        lengths = frame["length"].to_numpy(np.int64)
        bins, offsets, opened = vector_best_fit(lengths, capacity, weights, "norm" if fit == "fewest" else fit)
        if fit == "fewest" and opened > -(-lengths.sum() // int(capacity[0])):  # else no packing has fewer
            other = vector_best_fit(lengths, capacity, weights, "dot")
            bins, offsets, _ = min((bins, offsets, opened), other, key=lambda x: x[2])
        frame["sequence_id"] = (frame["shard"].to_numpy(np.int64) << 32) + bins
        frame["offset"] = offsets
        return frame[["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]]

    return pack


def pack(found: DataFrame, length: int = LENGTH, max_documents: int = MAX_DOCUMENTS, max_attention: int | None = None,
         weights=WEIGHTS, fit: str = "fewest", shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """Places pieces (as `pieces` returns them): sequence_id and offset of each. `max_attention` is the
    limit of a sequence's sum of squared lengths, by default that of one piece of full length."""
    attention = max_attention or length * length
    if attention < length * length:
        # A piece must fit a bin of its own.
        raise ValueError("max_attention must admit a piece of full length")
    found = cut_lineage(found.withColumn("row", F.monotonically_increasing_id()))
    shards = found.count() // shard_pieces + 1
    capacity = np.array([length, max_documents, attention], dtype=float)
    return (
        found.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
        .groupBy("shard").applyInPandas(
            _pack_shard(capacity, np.array(weights), fit),
            "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
        )
    )


def pack_documents(docs: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID, **options) -> DataFrame:
    """Pieces of all documents with their places. `tokenizer`: path of a tokenizer file."""
    model = _read(tokenizer or tokenizer_file())
    return pack(pieces(docs, model, length, end_id), length, **options)


def sequence_ids(docs: DataFrame, packed: DataFrame, tokenizer: str | None = None, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """The packed sequences themselves: sequence_id and token ids, for documents with unique doc_id."""
    model = _read(tokenizer or tokenizer_file())
    tokens = _cut(docs, model, length, end_id, "ids", pa.list_(pa.int32()), lambda ids: ids.astype(np.int32))
    parts = packed.join(tokens.select("doc_id", "piece", "ids"), ["doc_id", "piece"]).groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    )
    return parts.select("sequence_id", F.flatten(F.col("parts.ids")).alias("ids"))
