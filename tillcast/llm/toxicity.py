"""Toxicity through a noisy channel.

What was written is seen as an intended text sent through a channel that replaces letters by look-alikes, puts signs
between letters, spreads letters over single characters between spaces, and repeats letters. A word, or a run of
three or more single characters between spaces, becomes a lattice: its parts are runs of one character, and each has
arcs for the letters it may stand for, for a sign that stands for nothing, for one or two letters out of many, and
for a space that is nothing or ends a word. A Viterbi search finds the restored words with the best sum of channel costs
and log-probabilities of a character trigram model. Words of letters alone without odd repetitions are what they are.
The restored text is scored by a logistic regression over its words and word beginnings.

The search is whole: a state is the last two characters, so there are at most as many as pairs of letters that
the parts before may stand for, none is pruned, and its work is linear in a word's length, which has no limit.
Closing and quoting marks around a word, and three or more of one sign at its edge ("the***"), stand for nothing.

The character model counts the trigrams of all documents (words of the corpus, each as often as it occurs). Its
alphabet is fixed, so what the driver holds has at most (len(ALPHABET) + 2)^3 counts. The regression learns from at
most `labelled_rows` labelled documents outside the held-out fold, those with the smallest hashes of their doc_id, and
keeps the `features` features that depend most on the label.

Defined results: a null or empty text has the score of a text without any feature. Rows without doc_id are scored and not
held out. Without labels of both kinds the score is the smoothed share of ones (0.5 without any). Repeated rows are
scored each; a doc_id with several labels learns the smallest; empty tables give empty tables.
"""

import math
import re
from collections import Counter
from itertools import groupby

import xxhash
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import WordCache, map_rows
from tillcast.llm.rule_ensemble import fold, labelled
from tillcast.session import cut_lineage

LABELLED_ROWS = 10_000
FEATURES = 1_000
LEAST_DOCUMENTS = 3
PENALTY = 0.0005
THRESHOLD = 0.5
BEGINNINGS = (3, 4, 5, 6)
ALPHABET = "abcdefghijklmnopqrstuvwxyzàáâãäåæçèéêëìíîïñòóôõöøùúûüýÿßœ"
# Fixed look-alikes: what a sign or digit may stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a",
    "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "h",
    "%": "aeiou", "&": "aeiou",
}
STAND_COST = 1.0
DROP_COST = 0.7
EDGE_DROP_COST = 0.5
SIGN_DROP_COST = 6.0
DIGIT_COST = 4.0
FOLD_COST = 1.0
FOLD_PAIR_COST = 2.0
BREAK_COST = 2.0
# A sign in this many places of a word stands between its letters.
BETWEEN = 3
_RARE_DOUBLE = 0.01
# Longer words are restored each time they occur, so that the kept ones have a bounded size.
_KEPT_LENGTH = 64
_ALONE = re.compile(r"(?<!\S)\S(?:\s+\S){2,}(?!\S)")
_THREE_ALONE = re.compile(r"\s\S\s+\S\s+\S\s")
_DOUBLE = re.compile(f"([{ALPHABET}])\\1")
_TRIPLE = re.compile(f"([{ALPHABET}])\\1\\1")
_DECORATION = re.compile(r"^(\W)\1{2,}|(\W)\2{2,}$")
_EDGES = ".,;:?\"')[]{}`~^_=-/\\"
# Look-alikes that also open or close something, and then stand for nothing.
_OPENING, _CLOSING = "(<¡", "!|+(<¡*#%&"


class CharModel:
    """Trigram model with smaller ones behind it. "^" stands before and after a word, "?" for other characters."""

    def __init__(self, counts: dict[str, int]):
        self.three, two, one = counts, Counter(), Counter()
        self.before_three, self.before_two = Counter(), Counter()
        for gram, n in counts.items():
            two[gram[1:]] += n
            one[gram[2]] += n
            self.before_three[gram[:2]] += n
            self.before_two[gram[1]] += n
        self.two, self.one, self.all = two, one, sum(one.values())
        self.memo = WordCache(self._cost)
        self.rare = {c for c in ALPHABET if two[c + c] < _RARE_DOUBLE * max(1, self.before_two[c])}

    def _cost(self, gram):
        size = len(ALPHABET) + 2
        low = (self.one[gram[2]] + 1) / (self.all + size)
        mid = (self.two[gram[1:]] + 5 * low) / (self.before_two[gram[1]] + 5)
        return -math.log((self.three.get(gram, 0) + 5 * mid) / (self.before_three[gram[:2]] + 5))

    def odd_repeats(self, word):
        """Whether a letter comes three times, or twice where words rarely double it."""
        return any(c in self.rare for c in _DOUBLE.findall(word)) or _TRIPLE.search(word) is not None


def model_char(char: str) -> str:
    return char if char in ALPHABET else "?"


def _arcs(char, run, first, last, between):
    if char.isalpha():
        if run == 1 or char not in ALPHABET:
            return [(char * run, 0.0)]
        return [(char, FOLD_PAIR_COST), (char * 2, 0.0)] if run == 2 else [(char, FOLD_COST), (char * 2, FOLD_COST)]
    if char == " ":
        return [("", 0.0), (" ", BREAK_COST)]
    stands = LOOKALIKES.get(char, "")
    if run == 1:
        arcs = [(letter, STAND_COST) for letter in stands]
    else:
        arcs = [(letter, STAND_COST + FOLD_COST) for letter in stands]
        arcs += [(a + b, 2 * STAND_COST) for a in stands for b in stands]
    if char.isdigit():
        return [*arcs, (char * run, DIGIT_COST * run)]  # a digit is never nothing
    # A sign at an edge closes a sentence more often than it hides a letter.
    if last and (not stands or char in _CLOSING) or first and char in _OPENING:
        return [("", EDGE_DROP_COST), *arcs]
    return [("", DROP_COST if between or not stands else SIGN_DROP_COST), *arcs]


def lattice(word: str) -> list[list[tuple[str, float]]]:
    """The arcs (letters, cost) of each run of one character. Letters may be none, one or two, or a space for a word's end.
    In a word with spaces each character is a part of its own."""
    runs = [(char, sum(1 for _ in same)) for char, same in groupby(word)]
    end = -1 if " " in word else len(runs) - 1  # spread letters have no edge signs
    places = Counter(char for char, _ in runs)
    return [
        _arcs(char, run, at == 0 <= end, at == end, places[char] >= BETWEEN) for at, (char, run) in enumerate(runs)
    ]


def decode(word: str, model: CharModel) -> str:
    """The best path through the word's lattice, by Viterbi over the last two characters. Paths share their
    beginnings as linked pairs, so those that no state continues are freed."""
    states = {"^^": (0.0, None)}
    cost_of = model.memo
    for arcs in lattice(word):
        after = {}
        chars = [(letters, price, [model_char(c) if c != " " else c for c in letters]) for letters, price in arcs]
        for last, (cost, made) in states.items():
            for letters, price, path in chars:
                now, total = last, cost + price
                for char in path:
                    if char == " ":
                        total += cost_of[now + "^"]
                        now = "^^"
                    else:
                        total += cost_of[now + char]
                        now = now[1] + char
                best = after.get(now)
                if best is None or total < best[0]:
                    after[now] = (total, (made, letters) if letters else made)
        states = after
    _, made = min(((cost + cost_of[last + "^"], made) for last, (cost, made) in states.items()), key=lambda end: end[0])
    found = []
    while made:
        made, letters = made
        found.append(letters)
    return "".join(reversed(found))


def restorer(model: CharModel):
    """Function from a lower-case word, or a run of single characters between spaces, to the restored words."""

    def restore(word):
        if " " not in word:
            word = _DECORATION.sub("", word.strip(_EDGES)).strip(_EDGES)
            if word.isalpha() and not model.odd_repeats(word):
                return word
        if not any(map(str.isalpha, word)):
            return word  # signs and numbers alone are no hidden word
        return decode(word, model)

    return restore


def units(text: str | None) -> list[str]:
    """The lower-case words; three or more single characters in a row are one unit with spaces inside."""
    text = (text or "").lower()
    if not _THREE_ALONE.search(f" {text} "):
        return text.split()
    found, at = [], 0
    for run in _ALONE.finditer(text):
        found += text[at:run.start()].split()
        found.append(" ".join(run[0].split()))
        at = run.end()
    return found + text[at:].split()


class Words(WordCache):
    """Remembers what is made of words up to _KEPT_LENGTH."""

    def __missing__(self, word):
        return self.make(word) if len(word) > _KEPT_LENGTH else super().__missing__(word)


class Shared:
    """For a broadcast: `make(*data)`, which a Python worker makes once and keeps from task to task, so that its words stay
    known. Only the data travel."""

    def __init__(self, make, *data):
        self.make, self.data, self.made = make, data, None

    def __reduce__(self):
        return Shared, (self.make, *self.data)

    def get(self):
        if self.made is None:
            self.made = self.make(*self.data)
        return self.made


def _restored_words(grams):
    return Words(restorer(CharModel(grams)))


def _word_keys(grams):
    restore = restorer(CharModel(grams))
    return Words(lambda word: [feature_key(f) for f in word_features(restore(word))])


def _word_weights(grams, weights):
    restore = restorer(CharModel(grams))

    def known(word):
        keys = map(feature_key, word_features(restore(word)))
        return {key: weights[key] for key in keys if key in weights} or None

    return Words(known)


def word_features(word: str) -> list[str]:
    """Features of a restored word, or of several between spaces."""
    return [f for part in word.split() for f in (part, *["^" + part[:n] for n in BEGINNINGS if len(part) >= n])]


def feature_key(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature.encode(), 3) - (1 << 63)


def character_counts(docs: DataFrame) -> DataFrame:
    """(gram, n): trigrams of the words of all documents. Each task adds up its own first."""
    words_kept, chars_kept = 200_000, 1 << 24

    def run(batches):
        import numpy as np
        import pyarrow as pa

        letters = np.array(sorted(map(ord, " " + ALPHABET)), "<u4")
        names = ["^", *map(chr, letters[1:]), "?"]
        size = len(names)

        def add(words, total):
            """Adds the trigrams of these words as numbers of three digits. A space, which is in no word, marks both ends."""
            marked = "".join([f"  {word} " for word in words])
            points = np.frombuffer(marked.encode("utf-32-le"), "<u4")
            at = np.searchsorted(letters, points).clip(max=size - 2)
            code = np.where(letters[at] == points, at, size - 1)
            length = np.fromiter(map(len, words), np.int64, len(words)) + 3
            times = np.repeat(np.fromiter(words.values(), np.float64, len(words)), length)
            ends = np.cumsum(length)
            times[ends - 1] = times[ends - 2] = 0
            total += np.bincount((code[:-2] * size + code[1:-1]) * size + code[2:], times[:-2], size**3)
            words.clear()

        words, chars, total = Counter(), 0, np.zeros(size**3)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                text = (text or "").lower()
                words.update(text.split())
                chars += len(text)
                if words and (len(words) > words_kept or chars > chars_kept):
                    add(words, total)
                    chars = 0
        if words:
            add(words, total)
        found = np.flatnonzero(total)
        grams = [names[i // size**2] + names[i // size % size] + names[i % size] for i in found.tolist()]
        yield pa.RecordBatch.from_pydict({
            "gram": pa.array(grams, pa.string()), "n": pa.array(total[found].astype(np.int64))
        })

    return docs.select("text").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def character_model(docs: DataFrame) -> dict[str, int]:
    return {row.gram: row.n for row in character_counts(docs).collect()}


def restored_features(docs: DataFrame, grams: dict[str, int]) -> DataFrame:
    """doc_id, label and the keys of the different features of the restored words."""
    shared = docs.sparkSession.sparkContext.broadcast(Shared(_word_keys, grams))

    def make():
        keys = shared.value.get()
        return lambda doc_id, label, text: ((doc_id, label, list({k for word in set(units(text)) for k in keys[word]})),)

    rows = docs.select("doc_id", "label", "text")
    return map_rows(rows, make, doc_id="long", label="double", keys="array<long>")


def restored_text(docs: DataFrame, grams: dict[str, int]) -> DataFrame:
    """doc_id and the restored text, its words between single spaces."""
    shared = docs.sparkSession.sparkContext.broadcast(Shared(_restored_words, grams))

    def make():
        words = shared.value.get()
        return lambda doc_id, text: ((doc_id, " ".join(map(words.__getitem__, units(text)))),)

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), make, doc_id="long", text="string")


def fit(train: DataFrame, features: int = FEATURES, penalty: float = PENALTY):
    """(intercept, {feature key: weight}) from rows with keys and `label`."""
    train = cut_lineage(train)
    ones, rows = train.agg(F.sum("label"), F.count(F.lit(1))).first()
    share = ((ones or 0) + 1) / (rows + 2)
    seen = train.select("label", F.explode("keys").alias("key")).groupBy("key").agg(
        F.count(F.lit(1)).alias("held"), F.sum("label").alias("toxic")
    ).filter(F.col("held") >= LEAST_DOCUMENTS)
    expected = F.col("held") * share
    apart = (F.col("toxic") - expected) * F.abs(F.col("toxic") - expected) / expected
    chosen = [str(row.key) for row in seen.filter(apart > 0).orderBy(apart.desc(), "key").limit(features).collect()]
    if not rows or ones in (0, rows) or not chosen:
        return math.log(share / (1 - share)), {}
    words = train.select("label", F.col("keys").cast("array<string>").alias("words"))
    vectors = CountVectorizerModel.from_vocabulary(chosen, "words", "features").setBinary(True).transform(words)
    model = LogisticRegression(
        regParam=penalty, elasticNetParam=0.5, standardization=False, maxIter=60, tol=1e-5
    ).fit(cut_lineage(vectors.select("label", "features")))
    weights = model.coefficients.toArray().tolist()
    return model.intercept, {int(key): w for key, w in zip(chosen, weights) if w}


def scores(docs: DataFrame, grams: dict[str, int], intercept: float, weights: dict[int, float]) -> DataFrame:
    """doc_id and score (0 to 1) of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(Shared(_word_weights, grams, weights))

    def make():
        words = shared.value.get()

        def each(doc_id, text):
            found = {}
            for weighted in filter(None, map(words.__getitem__, set(units(text)))):
                found.update(weighted)
            total = intercept + math.fsum(found.values())
            yield doc_id, 1 / (1 + math.exp(-max(-500.0, min(500.0, total))))

        return each

    return map_rows(docs.select(F.col("doc_id").cast("long"), "text"), make, doc_id="long", score="double")


def toxicity_scores(docs: DataFrame, labels: DataFrame, held_out: Column | None = None,
                    labelled_rows: int = LABELLED_ROWS, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row. `held_out`: condition on doc_id of the documents
    whose labels are not learned from."""
    held_out = F.coalesce(fold(5) == 0 if held_out is None else held_out, F.lit(False))
    grams = character_model(docs)
    sample = labelled(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, "toxic", ~held_out, labelled_rows)
    intercept, weights = fit(restored_features(sample, grams))
    return scores(docs, grams, intercept, weights).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
