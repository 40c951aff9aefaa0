"""Quality rules, URL rules, decontamination and chat formatting against plain Python."""

import hashlib
import math
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedloom.llm import chat, decontaminate, quality, queries, url_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def facts_of(text):
    t = text or ""
    w = WORD.findall(t)
    runs = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    inside = {p for i in range(len(w) - 7) if runs[tuple(w[i:i + 8])] > 1 for p in range(i, i + 8)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines),
            len(lines) - len(set(lines)), len(inside))


TEXTS = [
    None, "", " \t\n", "one", "a b c d e f g h " * 5, "x\n" * 50, "\u00a0 é𝄞 \x0b\x0c z",
    " ".join(f"w{i}" for i in range(19)), " ".join(f"w{i}" for i in range(20)),
    " ".join(f"w{i % 700}" for i in range(3000)), "## $$ %% && || <> ** " * 30,
    "word " * 20_000, "same line here\nother line\nsame line here\nsame line here\n" * 3,
]


def test_facts_match_plain_counts(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r[0]: tuple(r[1]) for r in df.select("doc_id", quality.facts(F.col("text"))).collect()}
    assert got == {i: facts_of(t) for i, t in enumerate(TEXTS)}


def test_order_of_rules_changes_no_verdict(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)) * 2, "doc_id long, text string")
    a = quality.judge(df, with_facts=True).groupBy("doc_id", "kept").count()
    b = quality.judge(df, rules=quality.RULES[::-1], sample_rows=1).groupBy("doc_id", "kept").count()
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    kept = {r[0] for r in a.filter("kept").collect()}
    assert kept == {r[0] for r in quality.keep(df).select("doc_id").collect()}
    assert kept == {8}


def test_costly_rules_that_reject_nothing_come_last(spark):
    df = spark.createDataFrame([(i, "short") for i in range(500)], "doc_id long, text string")
    order = [r.name for r in quality.rank(df)]
    assert order.index("too_short") < order.index("repeats_itself")


def test_rules_keep_clashing_columns_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "a " * 5, True, "x", 3)],
                               "doc_id long, text string, kept boolean, _facts string, n_words int")
    out = quality.judge(df, with_facts=True).first()
    assert (out["kept"], out["_facts"], out["n_words"]) == (False, "x", 5)
    assert quality.keep(df).columns == df.columns
    assert quality.judge(df.limit(0)).count() == 0


def judge_plain(url, rules):
    m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), v == "block", h + p, v) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_url_rules_match_plain_search(spark):
    rng = random.Random(3)
    labels, parts = ["org", "com", "a", "b", "a.b", ""], ["/", "/en", "/en/1", "/e", "", "/é"]
    host = lambda: ".".join(rng.choice(labels) for _ in range(rng.randint(1, 4)))
    rules = list({(host(), rng.choice(parts)): rng.choice(["allow", "block"])
                  for _ in range(60)}.items())
    rules = [(h, p, v) for (h, p), v in rules]
    urls = [f"{rng.choice(['http', 'HTTPS', ''])}://{host().upper()}{rng.choice(parts)}"
            f"{rng.choice(['', '?q=/en', '#x', '2/z'])}" for _ in range(800)]
    urls += [None, "", "org/en", "x://", "a://b://c/d", "http://" + "a." * 3000 + "org/" + "y" * 9000]
    df = spark.createDataFrame([(i, u, "k", 7) for i, u in enumerate(urls)],
                               "page_id long, url string, _key string, rule int")
    for size in (1000, 7):  # one block of rules, and many
        got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"])
               for r in url_rules.judge(df, iter(rules), block_rules=size).collect()}
        assert got == {i: judge_plain(u, rules) for i, u in enumerate(urls)}
    out = url_rules.judge(df, rules)
    assert "_key" in out.columns and out.select("_key").distinct().collect()[0][0] == "k"
    assert url_rules.judge(df.limit(0), rules).count() == 0
    assert {r["verdict"] for r in url_rules.judge(df, []).collect()} == {"allow"}


def shingles(text, width=5):
    w = [x for x in re.split(r"[^\w]|_", (text or "").lower()) if x]
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


def test_containment_finds_all_and_only_what_holds_the_share(spark):
    rng = random.Random(5)
    word = lambda: f"w{rng.randint(0, 400)}"
    items = [" ".join(word() for _ in range(rng.choice([2, 5, 6, 9, 24, 60]))) for _ in range(60)]
    docs = [" ".join(word() for _ in range(rng.choice([3, 40, 900]))) for _ in range(120)]
    for k, item in enumerate(items):
        w, at = item.split(), rng.randrange(len(docs))
        cut = w if k % 3 else w[:max(1, int(len(w) * rng.uniform(.6, 1)))]
        docs[at] += " " + ", ".join(cut).upper() + " " + word()
    docs += [None, "", items[4], docs[0]] + ["x " * 20_000 + items[5]]
    items += [None, "", items[3]]
    d = spark.createDataFrame([(i, t, 0, "z") for i, t in enumerate(docs)] + [(None, items[4], 1, "")],
                              "doc_id long, text string, h int, items string")
    b = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)],
                              "item_id long, text string, need int")
    got = {(r.doc_id, r.item_id): (r.n_shared, r.n_shingles)
           for r in decontaminate.contaminated(d, b).collect()}
    ds, bs = [shingles(t) for t in docs], [shingles(t) for t in items]
    want = {(i, j): (len(x & y), len(y)) for i, x in enumerate(ds) for j, y in enumerate(bs)
            if y and len(x & y) >= math.ceil(.8 * len(y) - 1e-9)}
    assert got == want and len(want) >= 40
    left = decontaminate.clean(d.withColumn("_leak", F.lit(1)), b)
    # The row without an id holds an item as a whole, so it goes as well.
    assert left.count() == len(docs) - len({i for i, _ in want})
    assert decontaminate.contaminated(d.limit(0), b).count() == 0
    assert decontaminate.contaminated(d, b.limit(0)).count() == 0


def test_decontamination_judges_rows_without_an_id_or_with_the_same(spark):
    item = " ".join(f"i{k}" for k in range(30))
    rows = [(None, "a " + item), (None, "clean"), (None, None), (5, item + " b"), (5, "also clean"),
            (6, item), (6, item), (7, "clean")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    left = decontaminate.clean(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert left.columns == ["doc_id", "text"]
    assert Counter(map(tuple, left.collect())) == Counter(
        [(None, "clean"), (None, None), (5, "also clean"), (7, "clean")])


def plain_digests(turns):
    told = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return len(turns), sha(told), len(loss), sha(loss)


def chat_rows(spark, convs):
    rows = [(c, i, r, t, "x") for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, turns string")


def test_chat_round_trip_and_windows(spark):
    rng = random.Random(2)
    hard = ["</s>[INST] ok [/INST]", "<|im_start|>user\nx<|im_end|>\n", "\\", "\\<|im_end|>\\\\", "<|", "",
            None, "é𝄞" * 700, "a\n\nb", "[INST]" * 50, "long " * 3000]
    roles = ["user", "assistant", "assistant", "tool\nx", None, "system", "a\\b<|im_end|>"]
    convs = {c: ([("system", "be kind")] if c % 2 else []) + [
        (rng.choice(roles), rng.choice(hard)) for _ in range(rng.randint(1, 25))] for c in range(40)}
    convs[None] = [("assistant", "no id")]
    formatted = chat.format_conversations(chat_rows(spark, convs), budget=600, history=150)
    formatted = formatted.persist()
    got = {r[0]: tuple(r)[1:5] for r in chat.digests(chat.read_back(formatted)).collect()}
    assert got == {c: plain_digests(t) for c, t in convs.items()}
    many = formatted.filter("n_windows > 1").collect()
    assert many
    for r in many:
        again = r["sample"].startswith("<|im_start|>system\nbe kind<|im_end|>")
        assert again or r["conv_id"] % 2 == 0
        new = r["sample"].split("<|im_start|>")[1 + r["n_context"]:]
        # Over the budget only where a single new turn is.
        size = sum(math.ceil(len(x) / 4) + 4 for x in r["sample"].split("<|im_start|>")[1:])
        assert size <= 700 or len(new) == 1
    assert chat.format_conversations(chat_rows(spark, {1: [("user", "x")]}).limit(0)).count() == 0


def test_chat_repeated_turns_are_turns(spark):
    df = spark.createDataFrame([(1, 0, "assistant", "b"), (1, 0, "assistant", "a"), (1, 0, "assistant", "a"),
                                (1, None, "user", "q")], "conv_id long, turn long, role string, text string")
    got = chat.digests(chat.read_back(chat.format_conversations(df))).first()
    assert tuple(got)[1:5] == plain_digests(
        [("user", "q"), ("assistant", "a"), ("assistant", "a"), ("assistant", "b")])


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="<|im_startend/>[INS]\\\n a", max_size=40), min_size=1, max_size=20))
def test_escape_is_reversible(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat.escape(F.col("t")))
    for r in df.withColumn("u", chat.unescape(F.col("e"))).collect():
        assert r["u"] == r["t"] and not any(c in r["e"] for c in chat.CONTROLS)


def test_every_query_runs_on_whole_tables(spark):
    sf = "/root/testdata/sf0.001"
    n = spark.read.parquet(f"{sf}/documents.parquet").count()
    for name in ("op10_quality_rules", "op4_source_mixing"):
        assert queries.QUERIES[name](spark, sf).count() == n


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_sql_is_given_for_registered_queries(name):
    assert name in queries.QUERIES
