import random
import re

import pytest

from sievetally.llm import secret_scan
from sievetally.llm.secret_scan import BASE, MORE, Rule, secrets, span_text, trigram_index
from sievetally.llm.trigrams import trigram_query, trigrams_of

# As the contract spells them; letters of the words in either case.
PLAIN = {
    "assign": (r"((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    "access": (r"AKIA[A-Z0-9]+", 0, 16),
    "hex": (r"[0-9a-f]+", 0, 32),
}
EXTRA = {
    "private_key": (r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----", 0, 1),
    "web_token": (r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
}


def brute(text, patterns):
    found = [(m.start(), k, name, m.end()) for k, (name, (pattern, group, least)) in enumerate(patterns.items()) for m in re.finditer(pattern, text or "") if len(m[group]) >= least]
    return ",".join(f"{name}:{start}:{end}" for start, _, name, end in sorted(found))


H = "0123456789abcdef"
TEXTS = [
    "password = hunter2hunter2 x", "PassWd:'abcdefgh' y", "token: passwd: hunter2hunter2", "token=secret=abcdefghij", "api_key=12345678,apikey =\"1234567\"",
    "my_secret:  \"abc.def/gh+=\"", "token  = = abcdefgh", "secret" * 3 + "=abcdefgh", "ſecret=abcdefgh toKen=abcdefgh", "AKIAAKIA1234567890", "AKIA12345678901 AKIA123456789012",
    "xAKIAAKIAAKIAAKI AKIA", H * 2, H * 2 + "A" + H + "é" + H * 3, H + "0123456789abcde", "token=" + H * 2, "é😀 password=😀 secret=abcdefgh😀", "password" + " " * 30_000 + "=abcdefgh",
    "a" * 100_000, "-----BEGIN RSA PRIVATE KEY----- -----BEGIN PRIVATE KEY-----", "eyJhbGciOiJI.eyJzdWIiOiIx.c2lnbmF0dXJl", "AKIA" * 20_000, "token=" * 5_000, None, "", "\n",
]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)


def found(df, **options):
    return {r["doc_id"]: (r["b"], r["s"]) for r in secrets(df, **options).select("doc_id", span_text(secret_scan.F.col("base")).alias("b"), span_text(secret_scan.F.col("spans")).alias("s")).collect()}


def wanted(texts):
    return {i: (brute(t, PLAIN), brute(t, PLAIN | EXTRA)) for i, t in enumerate(texts)}


def test_finds_agree_with_the_plain_patterns(spark):
    assert found(frame(spark, TEXTS)) == wanted(TEXTS)


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    rng = random.Random(seed)
    parts = ["password", "PASSWD", "Secret", "token", "api_key", "apikey", ":", "=", " ", "'", '"', "abcdefgh", "12", "AKIA", "ABCDEF123456", H, "é", "x", "\n", ".", "-"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(500)]
    assert found(frame(spark, texts)) == wanted(texts)


def test_shards_and_crowded_marks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(secret_scan, "SHARD_TEXTS", 4)
    assert found(frame(spark, TEXTS * 3), mark_bits=8) == wanted(TEXTS * 3)


def test_queries_of_the_rules():
    words = [["api", "ike", "key", "pik"], ["_ke", "api", "i_k", "key", "pi_"], ["ass", "ord", "pas", "ssw", "swo", "wor"], ["ass", "pas", "ssw", "swd"], ["cre", "ecr", "ret", "sec"], ["ken", "oke", "tok"]]
    queries = {rule.name: [sorted(map(sorted, clause)) for clause in trigram_query(rule.pattern)] for rule in BASE + MORE}
    assert queries["assign"] == [sorted(words)]
    assert queries["access"] == [[["aki", "kia"]]] and queries["hex"] == []
    assert queries["web_token"] == [[["eyj"]], [[".ey", "eyj"]]]


@pytest.mark.parametrize("pattern", ["ab", "[a-z]{3}", "(abc)?", "(abc|d)", "(abc)*", "é+", "a.b.c", "x{0,2}", "(?=abc)z", "[^a]bcd?"])
def test_patterns_without_mandatory_trigrams(pattern):
    assert trigram_query(pattern) == []


@pytest.mark.parametrize(
    "pattern, text",
    [("(abc|abd)+x", "ABDabcx"), ("abc.*def", "abc  def"), ("(?i:AbC)d{2,3}e", "aBcddde"), ("a(bc|cd)?efg", "aefg"), ("(hello|help)(world|ed)", "helped"), ("x(abc.+def|ghi.+jkl)y", "xghi--jkly"), ("(?:foo ){2}bar", "foo foo bar"), ("abc+d", "abcccd"), ("[xy]abc", "yabc")],
)
def test_a_match_holds_its_query(pattern, text):
    query = trigram_query(pattern)
    held = {text.lower()[i : i + 3] for i in range(len(text))}
    assert re.search(pattern, text) and query and all(any(way <= held for way in clause) for clause in query)


def test_index_lists_every_text_once(spark):
    df = frame(spark, ["a Secret", "secret", "a Secret", "sec", "none"])
    lists = {r["trigram"]: r["rows"] for r in trigram_index(df, ["cre", "sec", "zzz"]).collect()}
    assert [len(lists[i]) for i in (0, 1)] == [2, 3] and 2 not in lists and all(x == sorted(x) for x in lists.values())
    assert set(lists[0]) <= set(lists[1])


def test_rules_of_ones_own(spark):
    rules = (Rule("ticket", r"TICKET-[0-9]+"), Rule("digits", r"[0-9]{3}"))
    df = frame(spark, ["TICKET-12345 and 678", "ticket-1", None])
    got = {r["doc_id"]: [tuple(s) for s in r["base"]] for r in secrets(df, base=rules, more=()).collect()}
    assert got == {0: [(0, 0, 12), (7, 1, 10), (17, 1, 20)], 1: [], 2: []}
    assert trigrams_of(trigram_query(rules[0].pattern)) == {"tic", "ick", "cke", "ket", "et-", *(f"t-{d}" for d in range(10))}
    assert [r["base"] for r in secrets(df, base=rules[1:], more=()).where("doc_id = 2").collect()] == [[]]


def test_no_python_on_the_executors_and_no_shuffle_of_texts(spark):
    plan = secrets(frame(spark, TEXTS))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|MapIn", plan)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1


def test_awkward_rows(edge_docs, no_docs):
    rows = secrets(edge_docs).collect()
    assert len(rows) == edge_docs.count() and all(r["spans"] == r["base"] for r in rows)
    assert secrets(no_docs).collect() == []
