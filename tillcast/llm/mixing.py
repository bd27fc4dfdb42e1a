"""Mixing documents to target weights by soft membership, in DataFrame operations only.

1. A labelled table trains a naive Bayes classifier over what is present: its domains are "toxic", "low"
   (quality 0) and "clean"; features are hashed words, hashed word beginnings, and a bin of length and
   repetition. A single absent feature says nothing, the absence of all of them is a feature. It learns from at most `labelled_rows` labelled documents (those with the smallest hashes) and keeps the
   `features` buckets that depend most, and clearly (chi-square of SURE, and of STRENGTH a document), on the domain. Every document gets domain posteriors.
2. Rates. With tokens n_i (words), posteriors p_id, domain totals T_d = sum n_i p_id and targets t_d, projected
   gradient descent minimises sum_d (sum_i r_i n_i p_id - t_d)^2 / T_d over rates r_i >= 0, from r_i = 1. In the
   metric that weighs documents by n_i its steps are

       r_i <- max(0, r_i - sum_d p_id (S_d - t_d) / T_d),   S_d = sum_i r_i n_i p_id

   and step size one is exact: the Hessian's largest eigenvalue is one. Each step moves one
   sum per domain to the driver and leaves documents where they are.
3. A rate becomes copies: its whole part, and one more if a hash of the doc_id (without one, of the row) is below the rest.

Defined results: a null text has no tokens and no features, and moves no total. Labels without
a matching document, or null, are not learned from; without any label all posteriors are equal. A domain of which
the documents have no tokens is left out of the targets. Repeated rows have equal rates. Rows of one doc_id, and rows
without one, have each the rate of their own text. Empty tables give empty tables.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import fresh, row_key
from tillcast.session import cut_lineage

DOMAINS = ("clean", "low", "toxic")
TARGETS = {"clean": 0.97, "low": 0.02, "toxic": 0.01}
LABELLED_ROWS = 20_000
FEATURES = 2_000
SMOOTHING = 10.0
SURE = 30.0
STRENGTH = 3.0
STEPS = 40
CLOSE = 1e-4
_WORDS = r"[\x20\x09-\x0D]+"


def domain():
    """Domain of a labelled row."""
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "clean")


def _featured(docs: DataFrame, *columns: str) -> DataFrame:
    """`columns`, tokens, and the different feature buckets of each document."""
    text = F.lower(F.coalesce("text", F.lit("")))
    counted = docs.select(*columns, F.filter(F.split(text, _WORDS), lambda w: w != "").alias("words")).select(
        *columns, F.size("words").cast("long").alias("tokens"), F.array_distinct("words").alias("words")
    )
    starts = F.transform("words", lambda w: F.concat(F.lit(" "), F.substring(w, 1, 4)))
    # Long texts repeat more of their words, so length and repetition make one feature.
    shape = F.array(F.concat_ws(
        " ", F.lit("  shape"), F.floor(F.log2(F.col("tokens") + 1)).cast("string"),
        F.floor(10 * F.size("words") / F.greatest("tokens", F.lit(1))).cast("string"),
    ))
    bucket = F.transform(F.concat("words", starts, shape), lambda w: F.xxhash64(w))
    some = F.when(F.col("tokens") > 0, F.array_distinct(bucket))
    return counted.select(*columns, "tokens", F.explode_outer(some).alias("bucket"))


def _copy_key():
    """Three smallest hashes of a text's long words, each by a hash of its own: near copies mostly share all three and count
    as one in training, or every word of a text with many copies would look typical of its domain. Different texts may share
    a frequent word of small hash, hardly three."""
    text = F.lower(F.coalesce("text", F.lit("")))
    long = F.filter(F.split(text, _WORDS), lambda w: F.length(w) > 8)
    least = [F.array_min(F.transform(long, lambda w, salt=salt: F.xxhash64(w, F.lit(salt)))) for salt in range(3)]
    return F.when(F.size(long) > 0, F.xxhash64(*least)).otherwise(F.xxhash64(text))


def train(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, features: int = FEATURES) -> DataFrame:
    """The classifier, by `kind`: "feature" rows have a bucket and for each domain the gain in log-likelihood
    if it is present, "none" the gain if no such bucket is present, "prior" the domains' logarithmic priors."""
    known = labels.select(F.col("doc_id").cast("long").alias("label_id"), domain().alias("domain"))
    sample = cut_lineage(
        known.filter("domain is not null and label_id is not null").groupBy("label_id").agg(F.min("domain").alias("domain"))
        .orderBy(F.xxhash64("label_id"), "label_id").limit(labelled_rows)
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("label_id"), "text").join(F.broadcast(sample), "label_id")
    seen = _featured(rows.withColumn("copy", _copy_key()), "label_id", "domain", "copy")
    of = {d: F.sum((F.col("domain") == d).cast("double")) for d in DOMAINS}
    counts = cut_lineage(
        seen.filter("bucket is not null").select("bucket", "domain", "copy").distinct().groupBy("bucket").agg(*[of[d].alias(d) for d in DOMAINS])
    )
    per = sample.join(docs.select(F.col("doc_id").cast("long").alias("label_id")).distinct(), "label_id", "left_semi")
    totals = {d: n or 0.0 for d, n in zip(DOMAINS, per.agg(*[of[d] for d in DOMAINS]).first())}
    rows_all = sum(totals.values())
    prior = {d: (totals[d] + 1) / (rows_all + len(DOMAINS)) for d in DOMAINS}

    # How far the domains' counts are from what the bucket's total would give (chi-square).
    held = sum((F.col(d) for d in DOMAINS), F.lit(0.0))
    apart = F.lit(0.0)
    for d in DOMAINS:
        expected = held * (totals[d] / max(rows_all, 1.0))
        apart = apart + F.when(expected > 0, (F.col(d) - expected) * (F.col(d) - expected) / expected).otherwise(0.0)
    # Hundreds of faint features of a text are not independent and would drown the clear ones.
    clear = counts.filter((apart >= SURE) & (apart >= STRENGTH * held))
    chosen = cut_lineage(clear.orderBy(apart.desc(), "bucket").limit(features))
    # log P(domain | bucket) / P(domain); SMOOTHING documents of the prior keep rare buckets from deciding.
    gain = [F.log((F.col(d) + SMOOTHING * prior[d]) / (held + SMOOTHING) / prior[d]).alias(d) for d in DOMAINS]
    known = chosen.select("bucket", F.lit(1).alias("hit"))
    bare = (
        seen.join(F.broadcast(known), "bucket", "left").groupBy("label_id", "domain").agg(F.count("hit").alias("hits"))
        .filter("hits = 0").agg(*[F.coalesce(of[d], F.lit(0.0)).alias(d) for d in DOMAINS])
    )
    null = F.lit(None).cast("long").alias("bucket")
    priors = docs.sparkSession.range(1).select(F.lit("prior").alias("kind"), null, *[F.log(F.lit(prior[d])).alias(d) for d in DOMAINS])
    return chosen.select(F.lit("feature").alias("kind"), "bucket", *gain).unionByName(
        bare.select(F.lit("none").alias("kind"), null, *gain)
    ).unionByName(priors)


def posteriors(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS, features: int = FEATURES) -> DataFrame:
    """One row per document, evaluated once: doc_id, source, row_key, tokens, p_<domain>."""
    model = cut_lineage(train(docs, labels, labelled_rows, features))
    base, none = (model.filter(F.col("kind") == kind).first() for kind in ("prior", "none"))
    gains = model.filter("kind = 'feature'").select("bucket", *[F.col(d).alias(f"gain_{d}") for d in DOMAINS])
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text",
        row_key().alias("row_key"), F.monotonically_increasing_id().alias("row"),
    )
    found = (
        _featured(keyed, "row", "doc_id", "source", "row_key").join(F.broadcast(gains), "bucket", "left")
        .groupBy("row", "doc_id", "source", "row_key", "tokens")
        .agg(*[(F.coalesce(F.sum(f"gain_{d}"), F.lit(none[d])) + F.lit(base[d])).alias(d) for d in DOMAINS])
    )
    most = F.greatest(*[F.col(d) for d in DOMAINS])
    powers = {d: F.exp(F.col(d) - most) for d in DOMAINS}
    every = sum(powers.values(), F.lit(0.0))
    return cut_lineage(found.select("doc_id", "source", "row_key", "tokens", *[(powers[d] / every).alias(f"p_{d}") for d in DOMAINS]))


def fit_rates(scored: DataFrame, targets: dict[str, float] | None = None, total_tokens: float | None = None,
              most: float | None = None, steps: int = STEPS, close: float = CLOSE, whole: str | None = None):
    """(`rate` as a column of `scored`, report). `total_tokens` is by default the most that needs no domain more
    than once, or with `whole` what takes that domain once; `most` bounds the rates from above. A domain with fewer
    tokens than its target then falls short. Ends when all domains are within `close` of their target, or as near as
    they get."""
    targets = targets or TARGETS
    names = list(targets)

    def sums(weight):
        row = scored.agg(*[F.sum(weight * F.col("tokens") * F.col(f"p_{d}")) for d in names]).first()
        return {d: v or 0.0 for d, v in zip(names, row)}

    rate = F.lit(1.0)
    held = sums(rate)
    names = [d for d in names if held[d] > 0 and targets[d] > 0]
    weight = sum(targets[d] for d in names)
    share = {d: targets[d] / weight for d in names}
    total = total_tokens if total_tokens is not None else min((held[d] / share[d] for d in names), default=0.0)
    if total_tokens is None and whole in names:
        total = held[whole] / share[whole]
    goal = {d: total * share[d] for d in names}
    if whole is not None and most is not None:
        # What a scarce domain lacks must not draw in documents of other domains that hold a trace of it.
        goal = {d: min(goal[d], most * held[d]) for d in names}
    now, done = held, 0
    for done in range(1, steps + 1):
        if all(abs(now[d] - goal[d]) <= close * goal[d] for d in names):
            break
        move = sum((F.col(f"p_{d}") * F.lit((now[d] - goal[d]) / held[d]) for d in names), F.lit(0.0))
        rate = F.greatest(F.lit(0.0), rate - move)
        if most is not None:
            rate = F.least(F.lit(float(most)), rate)
        before, now = now, sums(rate)
        if all(abs(now[d] - before[d]) <= close * close * held[d] for d in names):
            break
    report = {d: {"available": held[d], "target": goal[d], "expected": now[d]} for d in names}
    return rate, {"steps": done, "domains": report}


def _copies(rate):
    dice = F.pmod(F.xxhash64(F.coalesce("doc_id", "row_key"), F.lit("mixing")), F.lit(1 << 53)) / F.lit(float(1 << 53))
    return F.floor(rate + dice).cast("long")


def mixture(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, total_tokens: float | None = None,
            most: float | None = None, labelled_rows: int = LABELLED_ROWS, features: int = FEATURES,
            whole: str | None = None) -> DataFrame:
    """One row per document: doc_id, source, tokens, p_<domain>, rate, copies."""
    return _mixture(docs, labels, targets, total_tokens, most, labelled_rows, features, whole).drop("row_key")


def _mixture(docs, labels, targets=None, total_tokens=None, most=None, labelled_rows=LABELLED_ROWS, features=FEATURES,
             whole=None):
    scored = posteriors(docs, labels, labelled_rows, features)
    rate, _ = fit_rates(scored, targets, total_tokens, most, whole=whole)
    return scored.withColumn("rate", rate).withColumn("copies", _copies(F.col("rate")))


def mixed_documents(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The rows of `docs`, as often as their copies say, each by its own text, with or without doc_id."""
    key, times = fresh(docs, "row_key"), fresh(docs, "mix_times")
    chosen = _mixture(docs, labels, **options).filter("copies > 0").groupBy(F.col("row_key").alias(key)).agg(
        F.max("copies").alias(times)
    )
    kept = docs.withColumn(key, row_key()).join(chosen, key)
    return kept.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))).select(*docs.columns)
