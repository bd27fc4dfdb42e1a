"""Classifiers and mixing: held-out accuracy, and the numbers beside brute force."""

import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillcast.llm import mixing, rule_ensemble, toxicity

from conftest_llm import SF, values


@pytest.fixture(scope="module")
def larger(spark):
    folder = SF.replace("0.001", "0.01")
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


def accuracy(scored, labels, label):
    rows = scored.join(labels, "doc_id").filter("held_out").select("predicted", label).collect()
    return len(rows), sum(r[0] == r[1] for r in rows) / len(rows), sum(r[1] for r in rows) / len(rows)


# --- quality ---------------------------------------------------------------

def test_quality_on_held_out_documents(larger):
    docs, labels = larger
    scored = rule_ensemble.quality_scores(docs, labels)
    n, right, ones = accuracy(scored, labels, "quality")
    assert n > 50 and right > 0.95 > ones
    folds = {r.doc_id: r.held_out for r in scored.collect()}
    assert all(held == (zlib.crc32(str(i).encode()) % 4 == 2) for i, held in folds.items())
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan  # the compiled rules are columns


def test_rules_are_read_from_trees():
    tree = """DecisionTreeClassificationModel: depth=2
  If (feature 3 <= 0.5)
   If (feature 1 <= 2.0E-4)
    Predict: 0.0
   Else (feature 1 > 2.0E-4)
    Predict: 1.0
  Else (feature 3 > 0.5)
   Predict: 1.0
"""
    assert rule_ensemble.tree_rules(tree) == [
        ((3, "<=", 0.5),), ((3, "<=", 0.5), (1, "<=", 0.0002)), ((3, "<=", 0.5), (1, ">", 0.0002)), ((3, ">", 0.5),),
    ]
    assert rule_ensemble.shortest(((2, "<=", 5.0), (0, ">", 1.0), (2, "<=", 3.0))) == ((0, ">", 1.0), (2, "<=", 3.0))


def test_compiled_score_equals_rule_sum(spark):
    rng = np.random.default_rng(1)
    rows = [tuple(map(float, rng.random(len(rule_ensemble.STATISTICS)))) for _ in range(40)]
    df = spark.createDataFrame(rows, list(rule_ensemble.STATISTICS))
    weighted = [(1.5, ((0, "<=", 0.5), (3, ">", 0.2))), (-2.0, ((1, ">", 0.4),)), (0.5, ((13, "<=", 0.9),))]
    got = [r[0] for r in df.select(rule_ensemble.compile_score(-0.3, weighted)).collect()]
    for row, value in zip(df.collect(), got):
        holds = [all(row[f] <= v if s == "<=" else row[f] > v for f, s, v in rule) for _, rule in weighted]
        assert value == pytest.approx(1 / (1 + np.exp(-(-0.3 + sum(w for (w, _), h in zip(weighted, holds) if h)))))


def test_statistics():
    s = dict(zip(rule_ensemble.STATISTICS, rule_ensemble.statistics("Ab cd.\nAb cd.\nxyz! #1")))
    assert (s["n_words"], s["dup_line_share"], s["distinct_share"], s["longest_word"]) == pytest.approx((6, 1 / 3, 4 / 6, 4))
    assert s["upper_share"] == pytest.approx(2 / 21) and s["symbol_share"] == pytest.approx(1 / 21)
    assert set(rule_ensemble.statistics(None)) == set(rule_ensemble.statistics(" \n")) == {0.0}


def test_scores_on_edges(spark, edge_docs, no_docs, edge_labels, edge_rows):
    for score in (rule_ensemble.quality_scores, toxicity.toxicity_scores):
        for labels in (edge_labels, edge_labels.limit(0)):
            rows = score(edge_docs, labels).collect()
            assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in edge_rows)
            assert all(0 <= r.score <= 1 and r.held_out is not None for r in rows)
        assert score(no_docs, edge_labels).count() == 0


# --- toxicity --------------------------------------------------------------

def test_toxicity_on_held_out_documents(larger):
    docs, labels = larger
    scored = toxicity.toxicity_scores(docs, labels)
    n, right, ones = accuracy(scored, labels, "toxic")
    assert n > 50 and right > 0.95 > 1 - ones
    folds = {r.doc_id: r.held_out for r in scored.collect()}
    assert all(held == (zlib.crc32(str(i).encode()) % 5 == 0) for i, held in folds.items())


def test_character_counts_cover_all_documents(spark, edge_docs, edge_rows):
    want = Counter()
    for _, text, *_ in edge_rows:
        for word in (text or "").lower().split():
            marked = "^^" + "".join(map(toxicity.model_char, word)) + "^"
            want.update(marked[i : i + 3] for i in range(len(marked) - 2))
    assert toxicity.character_model(edge_docs) == dict(want)


@pytest.fixture(scope="module")
def restore(larger):
    return toxicity.restorer(toxicity.CharModel(toxicity.character_model(larger[0])))


@pytest.mark.parametrize("written, meant", [
    ("stup1d", "stupid"), ("m0r0n", "moron"), ("stuuupid", "stupid"), ("tra$h", "trash"), ("l.o.s.e.r", "loser"), ("i-d-i-o-t", "idiot"),
    ("d1sgust1ng", "disgusting"), ("cl0wn", "clown"), ("the***", "the"), ("1995", "1995"), ("192.168.1.1", "192.168.1.1"), ("thing,", "thing"),
])
def test_restored_words(restore, written, meant):
    assert restore(written) == meant


def model_of(words):
    counts = Counter()
    for word in words.split():
        marked = "^^" + word + "^"
        counts.update(marked[i : i + 3] for i in range(len(marked) - 2))
    return toxicity.CharModel({gram: 5 * n for gram, n in counts.items()})


@pytest.mark.parametrize("written, meant", [
    ("stuuuuuuuuuuuuuuuuuuuuupid", "stupid"), ("d--i--s--g--u--s--t--i--n--g", "disgusting"), ("@$$hole", "asshole"),
    ("(rap", "crap"), ("(the", "the"), ("a$$", "ass"), ("h311", "hell"), ("id!0t", "idiot"), ("i d ! 0 t", "idiot"),
    ("y o u i d i o t", "you idiot"), ("i*d*i*o*t", "idiot"), ("of!!", "of"), ("that***", "that"), ("***", ""),
    ("s" * 300_000 + "tup1d", "stupid"), ("stup1d" * 5_000, "stupid" * 5_000),
    # Letters outside the alphabet are not folded.
    ("\u4eba\u4eba\u4eba!", "\u4eba\u4eba\u4eba"),
])
def test_words_of_any_length_and_spacing(written, meant):
    words = "ass asshole hell idiot crap you stupid disgusting pass class well the of that moron"
    if len(written) > 20_000:
        words += " stupidstupidstupid"
    assert toxicity.restorer(model_of(words))(written) == meant


def test_spaced_letters_and_restored_text(spark, larger):
    assert toxicity.units("You S t U\n p i  d thing \u00e9 a la") == ["you", "s t u p i d", "thing", "\u00e9", "a", "la"]
    assert toxicity.units("a b c") == ["a b c"] and toxicity.units(None) == toxicity.units(" \n") == []
    assert toxicity.units("x " * 50_000 + "end") == [" ".join("x" * 50_000), "end"]
    docs = spark.createDataFrame([(1, "A m0r0n and T.R.A.S.H here, t r a s h"), (2, None)], "doc_id long, text string")
    got = values(toxicity.restored_text(docs, toxicity.character_model(larger[0])))
    assert got == [(1, "a moron and trash here trash"), (2, "")]


def test_viterbi_equals_all_paths():
    """Also on words of many states, which no beam may prune, and with word ends inside."""
    model = toxicity.CharModel({"^^a": 5, "^ab": 4, "ab^": 4, "^^b": 2, "^ba": 2, "bba": 1, "bab": 3, "aba": 2, "ba^": 3, "^^o": 2, "^ou": 3, "ou^": 1})

    def cost(made):
        total = 0.0
        for word in made.split(" "):
            marked = ["^", "^", *map(toxicity.model_char, word), "^"]
            total += sum(model.memo["".join(gram)] for gram in zip(marked, marked[1:], marked[2:]))
        return total

    def best(word):
        return min(
            sum(price for _, price in path) + cost("".join(letters for letters, _ in path))
            for path in product(*toxicity.lattice(word))
        )

    def price_of(word, made):
        """The cheapest of the paths that give this text."""
        return min(
            sum(price for _, price in path) + cost(made)
            for path in product(*toxicity.lattice(word)) if "".join(letters for letters, _ in path) == made
        )

    words = ["4b", "aabb", "a*b", "bbb4", "8a8", "a.b.a", "@8!", "abba", "a*b&%a", "4**b8", "*&%*6", "8 4 b", "a b a b * b", "(b|d!0+", "66a&&1"]
    for word in words:
        assert price_of(word, toxicity.decode(word, model)) == pytest.approx(best(word))


def test_obfuscated_documents_score_like_plain_ones(spark, larger):
    docs, labels = larger
    grams = toxicity.character_model(docs)
    sample = rule_ensemble.labelled(docs.select("doc_id", "text"), labels, "toxic", F.lit(True), 10_000)
    intercept, weights = toxicity.fit(toxicity.restored_features(sample, grams))
    plain = "the moron and the idiot said the trash was there"
    hidden = "the m0r0n and the i.d.i.o.t said the t r a s h was there"
    rows = spark.createDataFrame([(1, plain), (2, hidden), (3, "the thing was there")], "doc_id long, text string")
    score = dict(values(toxicity.scores(rows, grams, intercept, weights)))
    assert score[1] == pytest.approx(score[2]) and score[3] < score[1]


# --- mixing ----------------------------------------------------------------

def brute_rates(tokens, shares, targets, total, most=None):
    held = tokens @ shares
    goal = total * np.array(targets)
    rate = np.ones(len(tokens))
    for _ in range(mixing.STEPS):
        now = (rate * tokens) @ shares
        if (abs(now - goal) <= mixing.CLOSE * goal).all():
            break
        rate = np.maximum(0, rate - shares @ ((now - goal) / held))
        if most is not None:
            rate = np.minimum(most, rate)
    return rate


@pytest.mark.parametrize("most", [None, 1.0])
def test_rates_equal_brute_force_and_meet_targets(spark, most):
    rng = np.random.default_rng(4)
    shares = rng.dirichlet([0.4, 0.2, 0.2], 300)
    tokens = rng.integers(0, 900, 300)
    rows = [(i, int(n), *map(float, p)) for i, (n, p) in enumerate(zip(tokens, shares))]
    scored = spark.createDataFrame(rows, "doc_id long, tokens long, p_clean double, p_low double, p_toxic double")
    targets = {"clean": 0.7, "low": 0.2, "toxic": 0.1}
    total = 0.5 * float(tokens.sum())
    rate, report = mixing.fit_rates(scored, targets, total, most)
    got = np.array([r[0] for r in scored.select(rate).collect()])
    assert np.allclose(got, brute_rates(tokens, shares, list(targets.values()), total, most)) and got.min() >= 0
    for d in targets:
        assert report["domains"][d]["expected"] == pytest.approx(total * targets[d], rel=0.02)


def test_mixture_of_labelled_documents(larger):
    docs, labels = larger
    mixed = mixing.mixture(docs, labels)
    assert mixed.columns == ["doc_id", "source", "tokens", "p_clean", "p_low", "p_toxic", "rate", "copies"]
    rows = mixed.collect()
    assert len(rows) == docs.count()
    assert all(abs(r.p_clean + r.p_low + r.p_toxic - 1) < 1e-9 and abs(r.copies - r.rate) < 1 for r in rows)
    # So few documents cannot meet the targets exactly; the rates give the totals of the best nonnegative ones.
    tokens = np.array([r.tokens for r in rows], float)
    shares = np.array([[r[f"p_{d}"] for d in mixing.DOMAINS] for r in rows])
    held, want = tokens @ shares, np.array([mixing.TARGETS[d] for d in mixing.DOMAINS])
    goal, best = (held / want).min() * want, np.ones(len(rows))
    for _ in range(2000):
        best = np.maximum(0, best - shares @ (((best * tokens) @ shares - goal) / held))
    reached = (np.array([r.rate for r in rows]) * tokens) @ shares
    assert np.allclose(reached, (best * tokens) @ shares, atol=1e-3 * goal.sum())
    assert abs(reached - goal).sum() < 0.25 * abs(held - goal).sum()
    known = mixed.join(labels.withColumn("domain", mixing.domain()), "doc_id").groupBy("domain").agg(F.avg("p_clean").alias("p"))
    mean = {r.domain: r.p for r in known.collect()}
    assert mean["clean"] > 0.7 > 0.3 > mean["toxic"]


def test_mixing_is_native(documents, labels):
    rows = mixing.mixed_documents(documents, labels)
    for df in (rows, mixing.posteriors(documents, labels)):
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().executedPlan().toString())


def test_mixing_on_edges(edge_docs, no_docs, edge_labels, edge_rows):
    for labels in (edge_labels, edge_labels.limit(0)):
        rows = mixing.mixture(edge_docs, labels).collect()
        assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in edge_rows)
        assert all(r.rate >= 0 and r.copies >= 0 for r in rows)
        mixed = mixing.mixed_documents(edge_docs, labels, most=1.0)
        assert mixed.columns == edge_docs.columns
        assert Counter(r.doc_id for r in mixed.collect()) <= Counter(r[0] for r in edge_rows)
    assert mixing.mixture(no_docs, edge_labels).count() == mixing.mixed_documents(no_docs, edge_labels).count() == 0


def test_copies_repeat_documents(spark, documents, labels):
    total = 2.5 * documents.select(F.sum(F.size(F.split("text", " ")))).first()[0]
    mixed = mixing.mixed_documents(documents, labels, total_tokens=total)
    times = Counter(r.doc_id for r in mixed.select("doc_id").collect())
    assert max(times.values()) >= 2
