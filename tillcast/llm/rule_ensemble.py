"""Quality classifier: a sparse ensemble of rules.

Every text is measured by STATISTICS. On labelled documents a forest of shallow trees is grown over them; each
path from a root to a node is a rule, the conjunction of its comparisons. A logistic regression
with a lasso penalty weighs the rules, most weights become zero, and the rest is compiled into one Spark
column expression, which scores all documents without Python.

It learns from at most `labelled_rows` labelled documents, those with the smallest hashes of their doc_id; labels
of the held-out fold are never read. Defined results: a null or empty text has statistics of 0 and a score.
Rows without doc_id are scored and not held out. Without labels the score is 0.5, with labels of one kind the
smoothed share of ones. Repeated rows are scored each; a doc_id with several labels learns the smallest; empty
tables give empty tables.
"""

import re
from collections import Counter

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import map_rows
from tillcast.llm.line_quality import repeated_words
from tillcast.session import cut_lineage

LABELLED_ROWS = 20_000
TREES = 40
DEPTH = 3
PENALTY = 0.001
SEED = 7
THRESHOLD = 0.7

STATISTICS = (
    "n_words", "mean_word_bytes", "longest_word", "distinct_share", "top_word_share", "repeat_share", "dup_line_share",
    "words_per_line", "upper_share", "digit_share", "symbol_share", "mark_share", "stop_share", "closing_share",
)
# Byte classes of the shares.
_UPPER = bytes(range(65, 91))
_DIGIT = bytes(range(48, 58))
_SYMBOL = b"#*$%&|<>=_{}[]\\^~@+/"
_MARK = b"!?;:\"'()-"


def statistics(text: str | None) -> tuple[float, ...]:
    """The values of STATISTICS, all 0 for a text without words."""
    data = (text or "").encode()
    words = data.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    n, size = len(words), len(data)
    inside = sum(map(len, words))
    times = Counter(words)
    lines = [line for line in data.split(b"\n") if line.strip()]

    def share(kind):
        return 1 - len(data.translate(None, kind)) / size

    common = times.most_common(1)[0][1]
    ended = sum(line.rstrip()[-1:] in (b".", b"!", b"?") for line in lines)
    short = sum(c for word, c in times.items() if len(word) <= 3)
    return (
        float(n), inside / n, float(max(map(len, times))), len(times) / n, common / n, repeated_words(words) / n,
        1 - len(set(lines)) / len(lines), n / len(lines), share(_UPPER), share(_DIGIT), share(_SYMBOL), share(_MARK),
        short / n, ended / len(lines),
    )


def text_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of every whole text."""

    def make():
        measured = statistics
        return lambda doc_id, text: ((doc_id, *measured(text)),)

    return map_rows(
        docs.select(F.col("doc_id").cast("long"), "text"), make, doc_id="long", **{s: "double" for s in STATISTICS}
    )


def fold(folds: int) -> Column:
    """crc32 of the doc_id as text, modulo `folds`."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds


def labelled(rows: DataFrame, labels: DataFrame, label: str, usable: Column, most: int) -> DataFrame:
    """`rows` with a column `label` of 0.0 or 1.0, of at most `most` labelled documents that are `usable`."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("label"))
    sample = (
        known.filter(usable & F.col("doc_id").isNotNull() & F.col("label").isin(0.0, 1.0))
        .groupBy("doc_id").agg(F.min("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    )
    return rows.join(F.broadcast(sample), "doc_id")


_IF = re.compile(r"(If|Else) \(feature (\d+) (<=|>) ([-+.\dEe]+)\)")


def tree_rules(text: str) -> list[tuple]:
    """Conjunctions of (feature, "<=" or ">", value) of all paths of a tree, from its printed form."""
    path, found = [], []
    for line in text.splitlines():
        match = _IF.search(line)
        if match:
            depth = len(line) - len(line.lstrip())
            while path and path[-1][0] >= depth:
                path.pop()
            _, feature, sign, value = match.groups()
            path.append((depth, (int(feature), sign, float(value))))
            found.append(tuple(condition for _, condition in path))
    return found


def shortest(rule: tuple) -> tuple:
    """The rule with at most one bound of each kind per feature, in a fixed order."""
    bounds = {}
    for feature, sign, value in rule:
        old = bounds.get((feature, sign))
        bounds[feature, sign] = value if old is None else (min if sign == "<=" else max)(old, value)
    return tuple((f, s, v) for (f, s), v in sorted(bounds.items()))


def rule_column(rule: tuple, names=STATISTICS) -> Column:
    """1.0 where all comparisons hold, else 0.0."""
    holds = None
    for feature, sign, value in rule:
        one = F.col(names[feature]) <= value if sign == "<=" else F.col(names[feature]) > value
        holds = one if holds is None else holds & one
    return F.when(holds, 1.0).otherwise(0.0)


def fit_rules(train: DataFrame, trees: int = TREES, depth: int = DEPTH, penalty: float = PENALTY):
    """(intercept, [(weight, rule)]) from rows with STATISTICS and `label`."""
    train = cut_lineage(train.coalesce(8))
    ones, rows = train.agg(F.sum("label"), F.count(F.lit(1))).first()
    if not rows or ones in (0, rows):
        import math

        share = ((ones or 0) + 1) / (rows + 2)
        return math.log(share / (1 - share)), []
    vectors = train.select("label", array_to_vector(F.array(*STATISTICS)).alias("features"))
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, maxBins=64, seed=SEED, featureSubsetStrategy="sqrt", minInstancesPerNode=5
    ).fit(vectors)
    rules = sorted({shortest(rule) for tree in forest.trees for rule in tree_rules(tree.toDebugString)})
    if not rules:
        rules = [((0, ">", -1.0),)]
    marked = cut_lineage(train.select("label", F.array(*[rule_column(r) for r in rules]).alias("marks")))
    model = LogisticRegression(
        elasticNetParam=1.0, regParam=penalty, standardization=False, maxIter=60, tol=1e-5
    ).fit(marked.select("label", array_to_vector("marks").alias("features")))
    weights = model.coefficients.toArray().tolist()
    return model.intercept, [(w, r) for w, r in zip(weights, rules) if w]


def _total(columns: list[Column]) -> Column:
    """Sum as a balanced tree, so that the expression stays flat."""
    while len(columns) > 1:
        columns = [sum(columns[i + 1 : i + 2], columns[i]) for i in range(0, len(columns), 2)]
    return columns[0]


def compile_score(intercept: float, weighted) -> Column:
    """The probability of label 1 as a column over STATISTICS."""
    total = _total([F.lit(float(intercept)), *[w * rule_column(rule) for w, rule in weighted]])
    return 1 / (1 + F.exp(-total))


def quality_scores(docs: DataFrame, labels: DataFrame, held_out: Column | None = None, labelled_rows: int = LABELLED_ROWS,
                   threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row. `held_out`: condition on doc_id of the documents
    whose labels are not learned from."""
    held_out = fold(4) == 2 if held_out is None else held_out
    held_out = F.coalesce(held_out, F.lit(False))
    measured = cut_lineage(text_statistics(docs))
    intercept, weighted = fit_rules(labelled(measured, labels, "quality", ~held_out, labelled_rows))
    return measured.select("doc_id", held_out.alias("held_out"), compile_score(intercept, weighted).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
