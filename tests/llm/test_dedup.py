"""Exact and near duplicates beside brute force."""

import hashlib
import random
import re
from itertools import combinations

import pytest
import xxhash
from pyspark.sql import functions as F

from tillcast.llm import exact_dedup, simhash
from tillcast.llm.components import components

from conftest_llm import values


def bare(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def brute_groups(rows):
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(bare(text), []).append((-len(text or ""), doc_id is None, doc_id))
    out = []
    for doc_id, text, *_ in rows:
        group = groups[bare(text)]
        keep = min(group, key=lambda g: (g[0], g[1], g[2] or 0))[2]
        out.append((doc_id, keep, len(group), doc_id == keep, hashlib.sha256(bare(text).encode()).hexdigest()))
    return out


def key(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("salts", [1, 64])
def test_exact_groups_equal_brute_force(edge_docs, edge_rows, salts):
    found = exact_dedup.duplicate_groups(edge_docs, salts)
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert key(map(tuple, found.collect())) == key(brute_groups(edge_rows))


def test_different_texts_of_one_digest_stay_apart(edge_docs, edge_rows):
    found = exact_dedup.duplicate_groups(edge_docs, digest=lambda content: F.lit("same"))
    assert key(r[:4] for r in map(tuple, found.collect())) == key(r[:4] for r in brute_groups(edge_rows))


def test_exact_dedup_keeps_one_row_of_each_text(edge_docs, edge_rows):
    left = exact_dedup.deduplicate(edge_docs)
    assert left.columns == edge_docs.columns
    kept = values(left, "doc_id", "text")
    assert len(kept) == len({bare(r[1]) for r in edge_rows})
    assert (6, edge_rows[5][1]) in kept and 7 not in {k[0] for k in kept}  # equally long: the smaller doc_id


def test_exact_dedup_longest_row_stays(spark):
    docs = spark.createDataFrame([(5, "a b"), (1, "ab"), (3, "a b"), (2, "a\x00b")], "doc_id long, text string")
    assert values(exact_dedup.deduplicate(docs)) == [(2, "a\x00b"), (3, "a b")]


def test_exact_dedup_is_native(edge_docs):
    for df in (exact_dedup.duplicate_groups(edge_docs), exact_dedup.deduplicate(edge_docs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas", plan)


def test_empty_tables(no_docs):
    assert exact_dedup.deduplicate(no_docs).count() == exact_dedup.duplicate_groups(no_docs).count() == 0
    assert simhash.near_duplicates(no_docs).count() == simhash.deduplicate(no_docs).count() == 0


def brute_fingerprint(text, size=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_and_random_links(spark):
    random.seed(3)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 100), (7, 7)]
    links += [(random.randrange(1000, 1400), random.randrange(1000, 1400)) for _ in range(250)]
    nodes = {n for link in links for n in link}
    want = brute_components(nodes, links)
    got = dict(values(components(spark.createDataFrame(links, "a long, b long"))))
    assert got == {n: c for n, c in want.items() if n != c}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("long_list", [0, 3, 64])
def test_links_connect_what_all_pairs_connect(spark, long_list):
    random.seed(5)
    prints = set()
    for _ in range(12):
        centre = random.getrandbits(64)
        for _ in range(25):
            prints.add(centre ^ sum(1 << b for b in random.sample(range(64), random.choice([0, 1, 2, 3, 4]))))
    prints |= {0, 3, (1 << 63) | 1, (1 << 64) - 1}
    want = brute_components(prints, [(a, b) for a, b in combinations(prints, 2) if (a ^ b).bit_count() <= 2])
    signed = {p - (1 << 64) if p >> 63 else p: p for p in prints}
    classes = spark.createDataFrame([(p,) for p in signed], "fp long")
    found = [(signed[a], signed[b]) for a, b in values(simhash.fingerprint_links(classes, long_list))]
    assert all((a ^ b).bit_count() <= 2 for a, b in found)
    assert brute_components(prints, found) == want


def near_rows(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    texts = [t for _, t in rows[:12]]
    # Near copies with one word more, in groups, and exact copies of them.
    rows += [(1000 + 10 * i + k, f"{t} extra{k % 4}") for i, t in enumerate(texts) for k in range(8)]
    return rows


def test_near_duplicates_equal_brute_force(spark, documents, edge_rows):
    rows = near_rows(documents) + [(None if r[0] is None else 5000 + r[0], r[1]) for r in edge_rows]
    prints = [(doc_id, brute_fingerprint(text)) for doc_id, text in rows]
    different = {p for _, p in prints}
    root = brute_components(different, [(a, b) for a, b in combinations(different, 2) if (a ^ b).bit_count() <= 2])
    low = {}
    for doc_id, p in prints:
        if doc_id is not None:
            low[root[p]] = min(doc_id, low.get(root[p], doc_id))
    want = [(doc_id, f"{p:016x}", low.get(root[p])) for doc_id, p in prints]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert key(map(tuple, simhash.near_duplicates(docs, long_list=4).collect())) == key(want)
    kept = {doc_id for doc_id, _, component in want if doc_id == component and doc_id is not None}
    left = [r.doc_id for r in simhash.deduplicate(docs).collect()]
    assert sorted(x for x in left if x is not None) == sorted(kept)
    assert left.count(None) == sum(d is None for d, _ in rows)


def test_near_dedup_keeps_columns(edge_docs):
    left = simhash.deduplicate(edge_docs)
    assert left.columns == edge_docs.columns
    assert [r[0] for r in values(left, "doc_id")].count(7) == 0
