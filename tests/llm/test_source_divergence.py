import random
import re
from collections import Counter, defaultdict

import pytest

from sievetally.llm import sources
from sievetally.llm.sources import divergence, term_sums

TERMS = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def split(text):
    return TERMS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, least_docs, top):
    docs = [tuple(x or "" for x in row) for row in docs]
    out = []
    for lang in {d[1] for d in docs}:
        own = [(source, split(text)) for text, of, source in docs if of == lang]
        df = Counter(t for _, words in own for t in set(words))
        kept = {t for t, n in df.items() if n >= least_docs}
        counts = defaultdict(Counter)
        for source, words in own:
            counts[source].update(w for w in words if w in kept)
        whole = sum(counts.values(), Counter())

        def shares(bag):
            return {t: 1 + 10**9 * (bag[t] + 2) // (bag.total() + 2 * len(kept)) for t in kept}

        def apart(p, q):
            return (p - q) * (p - q) // (p + q)

        p, q = {s: shares(bag) for s, bag in counts.items()}, shares(whole)
        for s in counts:
            pairs = sorted((-sum(apart(p[s][t], p[o][t]) for t in kept), o.encode()) for o in counts if o != s)
            words = sorted((-apart(p[s][t], q[t]), t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, part, item.decode(), -v, i + 1) for part, found in (("pair", pairs), ("term", words)) for i, (v, item) in enumerate(found)]
    return sorted(out)


def frame(spark, docs):
    return spark.createDataFrame(docs, "text string, lang string, source string").repartition(3)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def random_docs(seed, n=400):
    rng = random.Random(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)] + ["É", "ñu", "THE", "the"]
    text = lambda: " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=rng.randrange(30)))
    copied = [text() for _ in range(6)]
    return [(rng.choice([None, "", *copied]) if rng.random() < 0.5 else text(), rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", "ü", "z", None])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(3))
def test_agrees_with_brute_force(spark, seed):
    docs = random_docs(seed)
    assert rows(divergence(frame(spark, docs), 10, 5)) == brute(docs, 10, 5)


def test_full_marks_and_small_sums_change_nothing(spark, monkeypatch):
    """With one bucket of marks and many texts some single texts go the way of copies, and partial sums are sent early."""
    docs = random_docs(9)
    monkeypatch.setattr(sources, "FLUSH_SUMS", 20)
    want = Counter()
    for text, lang, source in docs:
        want.update((lang or "", source or "", t) for t in split(text))
    got = {(r["lang"], r["source"], bytes(r["term"]).decode()): r["n"] for r in term_sums(frame(spark, docs), mark_bits=64).collect()}
    assert got == want


def test_copies_are_split_once(spark, monkeypatch):
    docs = [("one two three", "en", s) for s in "abcabcabca"] + [("four", "en", "a"), ("one two three", "de", "a")]
    seen = {(r["lang"], r["source"], bytes(r["term"])): (r["docs"], r["n"]) for r in term_sums(frame(spark, docs)).collect()}
    assert seen["en", "a", b"two"] == (4, 4) and seen["en", "c", b"two"] == (3, 3) and seen["de", "a", b"one"] == (1, 1)
    assert rows(divergence(frame(spark, docs), 10, 5)) == brute(docs, 10, 5)


def test_languages_without_kept_terms_and_groups_without_terms(spark):
    docs = [("a b", "xx", "s"), ("c", "xx", "t"), (None, "xx", None), ("7 8", "yy", "s")]
    docs += [("same words here", "zz", "s")] * 12 + [("...", "zz", "t")]
    got = rows(divergence(frame(spark, docs), 10, 5))
    assert got == brute(docs, 10, 5)
    assert [r for r in got if r[0] == "xx"] == [("xx", "", "pair", "s", 0, 1), ("xx", "", "pair", "t", 0, 2), ("xx", "s", "pair", "", 0, 1), ("xx", "s", "pair", "t", 0, 2), ("xx", "t", "pair", "", 0, 1), ("xx", "t", "pair", "s", 0, 2)]
    assert not [r for r in got if r[0] == "yy"]


def test_awkward_rows(spark, edge_docs, no_docs):
    docs = [(r["text"], r["lang"], r["source"]) for r in edge_docs.collect()]
    assert rows(divergence(edge_docs, 2, 5)) == brute(docs, 2, 5)
    assert divergence(no_docs).collect() == []


def test_counts_beyond_64_bits_when_scaled(spark):
    df = spark.createDataFrame([(10**12, 3 * 10**12, 10**6)], "n long, total long, kept long")
    got = df.select(sources._share(*(sources.F.col(c) for c in df.columns))).first()[0]
    assert got == 1 + 10**9 * (10**12 + 2) // (3 * 10**12 + 2 * 10**6)
