import math
import random
import re
from collections import Counter

import pytest

from sievetally.llm import ranking
from sievetally.llm.ranking import mine, rank
from sievetally.llm.terms import LETTERS_AND_DIGITS, term_counts

TERMS = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return TERMS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    bags = [(doc, Counter(split(text))) for doc, text in docs]
    bags = [(doc, bag) for doc, bag in bags if bag]
    n_docs, n_terms = len(bags), sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in items:
        found = []
        for doc, bag in bags:
            m = 10 + 90 * bag.total() * n_docs // n_terms
            score = sum(weight[t] * (10**9 * bag[t] // (1000 * bag[t] + 8 * m)) for t in set(split(text)) if t in bag)
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, doc, -score) for i, (score, _, _, doc) in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(items, "item_id long, text string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def random_tables(seed, n_docs=300, n_items=60):
    rng = random.Random(seed)
    words = [f"w{i}é"[: 2 + i % 3] + str(i % 7) for i in range(60)] + ["Alpha", "ALPHA", "ñ", "x_y", "3"]
    text = lambda n: " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=n))
    shared = [text(6) for _ in range(5)]
    docs = [(i, text(rng.randrange(40))) for i in range(n_docs)]
    return docs + docs[:5], [(i, f"{rng.choice(shared)} {text(4)}") for i in range(n_items)]


@pytest.mark.parametrize("seed", range(3))
def test_ranks_agree_with_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(ranking, "BLOCK_DOCS", 64)
    monkeypatch.setattr(ranking, "GROUP_QUERIES", 20)
    docs, items = random_tables(seed)
    assert rows(rank(*frames(spark, docs, items))) == brute(docs, items)


def test_batches_of_queries_give_the_same_ranks(spark):
    docs, items = random_tables(7, 100, 20)
    assert rows(rank(*frames(spark, docs, items), batch_bytes=300)) == brute(docs, items)


@pytest.mark.parametrize("seed", range(5))
def test_shared_parts_add_up_to_every_query(seed):
    rng = random.Random(seed)
    base = [rng.sample(range(200), 30) for _ in range(4)]
    queries = [sorted({*rng.sample(rng.choice(base), 20), *rng.sample(range(200), 10)}) for _ in range(80)]
    found = mine(queries, paired_parts=rng.choice([5, 1000]))

    def terms(part):
        return [part] if part >= 0 else [t for p in found.nodes[-1 - part] for t in terms(p)]

    assert [sorted(t for p in parts for t in terms(p)) for parts in found.queries] == queries
    assert all(p >= 0 or -1 - p < at for at, parts in enumerate(found.nodes) for p in parts)
    additions = sum(map(len, found.nodes)) + sum(map(len, found.queries))
    assert additions < sum(map(len, queries))


def test_equal_terms_of_the_same_queries_are_one_part():
    found = mine([[1, 2, 3, 4], [1, 2, 3, 5], [6]])
    assert found.nodes == [[1, 2, 3]] and found.queries == [[4, -1], [5, -1], [6]]


def test_ties_nulls_and_repeated_rows(spark):
    docs = [(5, "red fox"), (3, "red fox"), (None, "red fox"), (3, "red fox"), (1, None), (2, ""), (4, "blue"), (9, "... !")]
    items = [(1, "RED red"), (1, "red"), (None, "blue fox"), (2, None), (3, "?"), (4, "unseen")]
    got = rows(rank(*frames(spark, docs, items), k=3))
    assert got == brute(docs, items, 3)
    assert [(r, d) for i, r, d, _ in got if i == 1] == [(1, 3), (1, 3), (2, 3), (2, 3), (3, 5), (3, 5)]


def test_awkward_documents(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "une PHRASE two ñandú", "z"), (2, "aaa straße 😀", "z")], "item_id long, text string, score string")
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert rows(rank(edge_docs, items)) == brute(docs, [(r["item_id"], r["text"]) for r in items.collect()])
    assert rank(no_docs, items).collect() == [] and rank(edge_docs, items.limit(0)).collect() == []


def test_long_texts_are_read_in_slices(monkeypatch):
    text = "Ab cd é9 " * 50 + "x" * 40
    whole = term_counts(text.encode(), LETTERS_AND_DIGITS)
    monkeypatch.setattr("sievetally.llm.terms.SLICE_CHARS", 7)
    assert term_counts(text.encode(), LETTERS_AND_DIGITS) == whole == Counter({b"ab": 50, b"cd": 50, "é9".encode(): 50, b"x" * 40: 1})


def test_large_counts_stay_exact():
    import numpy as np
    import pyarrow as pa

    n_docs, n_terms, length, count = 10**10, 10**13, 2 * 10**9, 2**31 - 1
    block = ranking.Block(pa.array([1]), np.array([length]), np.array([0, 1]), np.array([0]), np.array([count]), np.array([23_000]), n_docs, n_terms)
    m = 10 + 90 * length * n_docs // n_terms
    assert block.scores.tolist() == [23_000 * (10**9 * count // (1000 * count + 8 * m))]
