import re

import pytest

from sievetally.llm import pii
from sievetally.llm.pii import KINDS, discovered, personal_data, redact, scan, span_text

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(x // 10 + x % 10 for x in doubled) % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


TEXTS = [
    "a@b.co_x@c.d @@ x@y.z.",
    ".@.@a.b@c.d a@b..c a@b.co.@x.y x@-.-",
    "1.2.3.45.6.7.8 9.9.9.999 0001.002.003.0004 1.2.3.4.5 00000000000000000001.1.1.1",
    "4111 1111 1111 1111 x 4111-1111-1111-1111-4 4111  1111 1111 1111 4111111111111111",
    "+1 (487) 555-7209 +12345 ++4912345678901 + 49 +1(2)3(4)5-6.7 8 9 0",
    "é😀 bob@x.org 😀+49 123 456 789 12",
    "9" * 50_000,
    " a" * 20_000 + "@b.c",
    "a.b" * 15_000,
    "x@" + "a." * 15_000 + "b",
    "+1" + " " * 40_000,
    "1.2.3.4" * 3 + " 1-" * 30,
    "u@v.w 10.0.0.1 " * 700,
    "",
    None,
]


def test_base_finds_agree_with_the_plain_patterns(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: r["s"] for r in personal_data(df).select("doc_id", span_text(pii.F.col("base")).alias("s")).collect()}
    assert got == {i: brute(t) for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("alphabet", ["a@.- _%", "0123456789.", "4 -1", "+(1) .-9x"])
def test_base_finds_of_random_texts(spark, alphabet):
    import random

    rng = random.Random(alphabet)
    texts = ["".join(rng.choices(alphabet, k=rng.randrange(60))) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = scan(df).select("doc_id", span_text(pii.F.col("base")).alias("s")).collect()
    assert {r["doc_id"]: r["s"] for r in rows} == {i: brute(t) for i, t in enumerate(texts)}


def contexts():
    """Ten phones with a plus after "call me", one text without; numbers after other words."""
    texts = [f"please call me +49 170 55512{i:02d} soon" for i in range(12)]
    texts += ["please call me 0170 5551299 soon", "the order 0170 5551298 came", "call me maybe 2024 soon", "please call me 0170 5551299 soon"]
    return list(enumerate(texts))


def test_contexts_of_seeds_discover_unseen_identifiers(spark):
    df = spark.createDataFrame(contexts(), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in personal_data(df).select("doc_id", span_text(pii.F.col("base")).alias("base"), span_text(pii.F.col("spans")).alias("spans")).collect()}
    assert rows[12]["base"] == "" and rows[12]["spans"] == "phone:15:27" == rows[15]["spans"]
    assert [rows[i]["spans"] for i in (13, 14)] == ["", ""]
    assert all(rows[i]["spans"] == rows[i]["base"] == "phone:15:30" for i in range(12))


SHAPES = {
    "email": lambda v: re.fullmatch(r"[^ \t\n\x0b\f\r@]+@[^ \t\n\x0b\f\r@]+", v),
    "ip": lambda v: re.fullmatch(r"[0-9]{1,4}(\.[0-9]{1,4}){3,}", v),
    "card": lambda v: re.fullmatch(r"[0-9][0-9 .-]+[0-9]", v) and 12 <= len(re.sub("[^0-9]", "", v)) <= 19,
    "phone": lambda v: re.fullmatch(r"[+(]?[0-9][0-9 ().-]+[0-9]", v) and 7 <= len(re.sub("[^0-9]", "", v)) <= 15,
}


def occurrences(text):
    """(start, stop, value, seed, patterns) of a text's candidates, word by word."""
    words = [(m.start(), m.end(), m[0]) for m in re.finditer(r"[^ \t\n\x0b\f\r]+", text)]
    numeric = [bool(re.search("[0-9]", w)) and "@" not in w and not any(c.isalpha() for c in w) for _, _, w in words]
    base = [(int(a), int(b), KINDS.index(kind)) for kind, a, b in (x.split(":") for x in brute(text).split(",") if x)]
    spans, i = [], 0
    while i < len(words):
        j = i
        while numeric[i] and j + 1 < len(words) and numeric[j + 1] and text[words[j][1] : words[j + 1][0]] == " ":
            j += 1
        if re.search("[0-9@]", words[i][2]):
            spans.append((i, j))
        i = j + 1
    near = lambda k, edge: re.sub("[0-9]", "0", words[k][2].lower()) if 0 <= k < len(words) else edge
    for i, j in spans:
        whole = text[words[i][0] : words[j][1]]
        letters = [k for k, c in enumerate(whole) if c.isalnum()]
        first = next((k for k, c in enumerate(whole) if c.isalnum() or c in "+("), None)
        if first is None:
            continue
        last = letters[-1] if letters and letters[-1] >= first else first
        start, value = words[i][0] + first, whole[first : last + 1]
        seeds = [k for a, b, k in base if a < words[j][1] and b > words[i][0]]
        seeds = [k for k in sorted(seeds)]
        yield start, start + len(value), value, seeds[0] if seeds else None, (f"<< {near(i - 2, '<start>')} {near(i - 1, '<start>')}", f"<> {near(i - 1, '<start>')} {near(j + 1, '<end>')}")


def brute_discovered(texts, rounds=3, least_score=0.8, least_seeds=5):
    """{text: spans beyond the base}, by plain loops over all distinct texts."""
    seen = [(text, *o) for text in {t or "" for t in texts} for o in occurrences(text)]
    edges = {}
    for _, _, _, value, seed, patterns in seen:
        for p in patterns:
            old = edges.get((p, value))
            edges[p, value] = seed if old is None else old if seed is None else max(old, seed)
    seeds = {(v, s): 1.0 for (_, v), s in edges.items() if s is not None}
    known, sure = dict(seeds), {}
    for turn in range(rounds):
        sure = {}
        for p in {p for p, _ in edges}:
            values = [v for q, v in edges if q == p]
            for k in range(len(KINDS)):
                scores = [known[v, k] for v in values if (v, k) in known]
                if len(scores) >= least_seeds and len(values) >= least_seeds and sum(scores) / (len(values) + 1) >= least_score:
                    sure[p, k] = sum(scores) / (len(values) + 1)
        known = dict(seeds)
        for (p, v), s in edges.items():
            for k in range(len(KINDS)):
                if s is None and (p, k) in sure and SHAPES[KINDS[k]](v):
                    known[v, k] = max(known.get((v, k), 0.0), sure[p, k])
    out = {}
    for text, start, stop, value, seed, patterns in seen:
        kinds = [k for p in patterns for k in range(len(KINDS)) if seed is None and (p, k) in sure and SHAPES[KINDS[k]](value)]
        if kinds:
            out.setdefault(text, set()).add((min(kinds), start, stop))
    return {t: sorted(x) for t, x in out.items()}


def found_beyond_base(spark, texts, **options):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = personal_data(df, **options).collect()
    return {texts[r["doc_id"]] or "": [tuple(s) for s in r["spans"] if s not in r["base"]] for r in rows if r["spans"] != r["base"]}


def mails(name, n=60):
    return [f"mail to {name}{i}@x{i}.org today" for i in range(n)]


@pytest.mark.parametrize("identifier", ["bob@local", "b@l", "x" * 70 + "@local", "a" * 5000 + "@" + "b" * 5000])
def test_identifiers_of_any_length(spark, identifier):
    texts = [*mails("ann"), f"mail to {identifier} today", f"please mail to {identifier}"]
    got = found_beyond_base(spark, texts)
    assert got == brute_discovered(texts)
    assert got[texts[60]] == [(0, 8, 8 + len(identifier))] and got[texts[61]] == [(0, 15, 15 + len(identifier))]


def test_identifiers_among_numbers_and_long_words(spark):
    long = "w" * 200
    texts = [*mails("ann"), *(f"{long} {long}s u{i}@y{i}.org" for i in range(20))]
    texts += ["mail to bob@local 17 2024", "mail to bob@local 12 ab3 x", "12 mail to bob@local, 5", f"{long} {long}s eve@host 9", f"{long} {long}z eve@host"]
    got = found_beyond_base(spark, texts)
    assert got == brute_discovered(texts)
    assert [got.get(t) for t in texts[-5:]] == [[(0, 8, 17)], [(0, 8, 17)], [(0, 11, 20)], [(0, 403, 411)], None]


@pytest.mark.parametrize("seed", range(4))
def test_discoveries_agree_with_plain_loops(spark, seed):
    import random

    rng = random.Random(seed)
    fillers = ["call", "me", "at", "now", "the", "order", "x1", "7", "2024,", "so-so", "é", "(", "+", "\n", "ip"]

    def identifier():
        kind = rng.randrange(6)
        digits = "".join(rng.choices("0123456789", k=10))
        return [f"u{digits[:3]}@h{digits[3:5]}.org", f"u{digits[:2]}@host", f"+49 170 {digits[:6]}", f"0170 {digits[:6]}", f"10.0.{digits[0]}.{digits[1:3]}", f"300.1.{digits[0]}.{digits[1:3]}"][kind]

    texts = []
    for _ in range(500):
        lead = rng.choice(["write to", "call me at", "host is", "room"])
        parts = [*rng.choices(fillers, k=rng.randrange(4)), lead, identifier(), *rng.choices(fillers, k=rng.randrange(4))]
        texts.append(" ".join(parts))
    texts += texts[:50] + [None, ""]
    options = {"rounds": 3, "least_score": 0.3, "least_seeds": 3}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    scanned = scan(df)
    key = {r["key"]: texts[r["doc_id"]] or "" for r in scanned.select("key", "doc_id").collect()}
    got = {key[r["key"]]: [tuple(s) for s in r["added"]] for r in discovered(scanned, **options).collect()}
    assert got == brute_discovered(texts, **options) and len(got) > 20


def test_crowded_marks_change_nothing(spark):
    texts = [t for _, t in contexts()] * 3
    assert found_beyond_base(spark, texts, mark_bits=8) == found_beyond_base(spark, texts) == brute_discovered(texts)


def test_few_or_doubtful_seeds_discover_nothing(spark):
    few = spark.createDataFrame(contexts()[9:], "doc_id long, text string")
    assert discovered(scan(few)).collect() == []
    doubtful = contexts() + [(100 + i, f"please call me 0{i} 55512{i:02d} soon") for i in range(20)]
    assert discovered(scan(spark.createDataFrame(doubtful, "doc_id long, text string"))).collect() == []


def test_sure_strings_make_other_patterns_sure(spark):
    """Twenty strings become sure beside many seeds; they make a pattern without seeds sure, and that finds one more."""
    rows = [f"please call me +49 170 5{i:06d} soon" for i in range(200)]
    rows += [f"please call me 0170 6{i:06d} soon" for i in range(20)]
    rows += [f"reach us under 0170 6{i:06d} now" for i in range(20)] + ["reach us under 0170 7000000 now"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    sets = {rounds: {r["key"] for r in discovered(scan(df), rounds=rounds).collect()} for rounds in (1, 2)}
    assert [len(sets[r]) for r in (1, 2)] == [20, 41]


def test_no_python_on_the_executors(spark):
    df = spark.createDataFrame(contexts(), "doc_id long, text string")
    for frame in (personal_data(df), redact(df)):
        plan = frame._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow|MapInPandas", plan)


def test_awkward_rows(edge_docs, no_docs):
    rows = personal_data(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    mail = [r for r in rows if r["doc_id"] == 11]
    assert [KINDS[s["kind"]] for s in mail[0]["spans"]] == ["email", "phone"]
    assert personal_data(no_docs).collect() == [] and redact(no_docs).collect() == []


def test_redaction(edge_docs, spark):
    out = redact(edge_docs)
    assert out.columns == edge_docs.columns and out.count() == edge_docs.count()
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[11] == "mail [EMAIL] or call [PHONE]" and texts[3] is None and texts[4] == ""
    mixed = spark.createDataFrame([(1, "+4111 1111 1111 1111 x a@1.2.3.4 y"), *((i + 2, t) for i, t in contexts())], "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in redact(mixed).collect()}
    assert got[1] == "+[CARD] x [EMAIL] y"
    assert got[14] == "please call me [PHONE] soon" == got[2]
