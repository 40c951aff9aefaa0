"""The near-copy stage against all pairs."""

import random

import numpy as np

import corpus_pipeline
from feedloom.llm import near_copies
from tests.llm.test_corpus import DOCS


def shingles(text):
    w = (text or "").lower().split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def kept_ids(rows):
    """Smallest id of each component of pairs with a Jaccard similarity of 0.8 or more."""
    sets = {i: shingles(t) for i, t in rows}
    seen, kept = set(), set()
    for i in sorted(sets):
        if i in seen:
            continue
        kept.add(i)
        todo = [i]
        while todo:
            x = todo.pop()
            seen.add(x)
            todo += [y for y in sets if y not in seen and y not in todo
                     and 5 * len(sets[x] & sets[y]) >= 4 * len(sets[x] | sets[y])]
    return kept


def planted(rng):
    """Texts with copies of changed words, a common line, chains and a large group."""
    text = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    line, group = text(12), text(120)
    rows = []
    for _ in range(40):
        w = text(rng.choice([30, 90, 200, 400]))
        rows.append(w + line)
        for _ in range(rng.randrange(4)):
            c = list(rng.choice([w, rows[-1]]))
            for _ in range(rng.choice([0, 1, 2, 4, 8])):
                c[rng.randrange(len(c))] = f"x{rng.random()}"
            rows.append(c + line)
    for _ in range(40):
        c = list(group)
        for _ in range(rng.randrange(1, 5)):
            c[rng.randrange(120)] = f"y{rng.random()}"
        rows.append(c)
    rows = [" ".join(w) for w in rows] + ["One two", "one TWO", "", "  "]
    ids = rng.sample(range(10_000), len(rows))
    return list(zip(ids, rows))


def test_stage_keeps_one_of_each_component_of_near_copies(spark, monkeypatch):
    for k, settings in enumerate(({}, {"PAIRED": 2, "ROUNDS": 1, "SAMPLE": 50, "LED": 2, "BROADCAST": 900})):
        for name, v in settings.items():
            monkeypatch.setattr(near_copies, name, v)
        rows = planted(random.Random(k))
        df = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], DOCS).repartition(4)
        got = corpus_pipeline.simhash_near_dedup(spark, df.withColumn("_node", df.n_chars), "")
        assert got.columns == [*df.columns, "_node"]
        got = [(r.doc_id, r.text) for r in got.collect()]
        want = kept_ids(rows)
        assert sorted(got) == sorted((i, t) for i, t in rows if i in want)
        assert len(want) < len(rows) - 40
    assert near_copies.keep_first(df.limit(0)).count() == 0


def test_one_row_stays_of_copies_without_an_id_or_with_the_same(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(None, a), (None, a), (None, a.replace("a0 ", "z ")), (5, b), (5, b), (5, b.upper()),
            (7, None), (7, ""), (8, "c d"), (8, "e f"), (None, "g h"), (9, "g h")]
    df = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], DOCS).repartition(3)
    got = [(r.doc_id, (r.text or "").lower()) for r in near_copies.keep_first(df).collect()]
    assert len(got) == 6 and sum(i is None for i, _ in got) == 1
    assert {x for x in got if x[0] is not None} == {
        (5, b), (7, ""), (8, "c d"), (8, "e f"), (9, "g h")}


def test_pairs_that_share_few_shingles_are_told_apart_without_their_texts(spark, monkeypatch):
    """Two texts of a pair meet in their prefixes, a third of their words being the same."""
    rng, met = random.Random(5), []
    text = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    rows = []
    for _ in range(60):
        line = text(40)
        rows += [(len(rows) + k, " ".join(text(80) + line)) for k in (0, 1)]
    rows += [(200 + i, t + " more") for i, t in rows[:3]]
    fit = near_copies._fit

    def counted(pairs, share):
        met.append(pairs.count())
        return fit(pairs, share)

    monkeypatch.setattr(near_copies, "_fit", counted)
    df = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], DOCS).repartition(4)
    got = sorted(r.doc_id for r in near_copies.keep_first(df).collect())
    assert got == sorted(kept_ids(rows)) == list(range(120))
    assert 0 < sum(met) <= 4


def test_pairs_tried_grow_with_a_group_of_changed_copies_not_with_its_square(spark, monkeypatch):
    """Copies that are like the text they were made from, but not like one another, and some
    that are changed too much even for that."""
    rng, may, tried = random.Random(8), near_copies._Texts.may, []
    base = [f"w{i}" for i in range(150)]
    rows = [(70, " ".join(base))]
    for i in [*range(70), *range(71, 120)]:
        c = list(base)
        for k, at in enumerate(rng.sample(range(6, 144, 8), 4 if i % 10 == 0 else rng.choice([2, 3]))):
            c[at] = f"x{i}_{k}"
        rows.append((i, " ".join(c)))

    def counted(texts, pairs, share):
        tried.append(pairs.count())
        return may(texts, pairs, share)

    monkeypatch.setattr(near_copies._Texts, "may", counted)
    df = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], DOCS).repartition(4)
    got = sorted(r.doc_id for r in near_copies.keep_first(df).collect())
    assert got == sorted(kept_ids(rows)) and 1 < len(got) < 20
    assert sum(tried) <= 2 * len(rows)


def test_parities_bound_the_difference():
    rng = np.random.default_rng(3)
    for n in (1, 5, 64, 65, 700, 1025):
        a = np.unique(rng.integers(-2 ** 63, 2 ** 63 - 1, n))
        b = np.unique(np.append(a[n // 9:], rng.integers(-2 ** 63, 2 ** 63 - 1, n // 9)))
        one, two = near_copies._parities(a), near_copies._parities(b)
        if len(one) != len(two):
            one, two = sorted((one, two), key=len)
            two = two[:len(one)] ^ two[len(one):]
        assert len(one) * 64 >= min(64, n) and len(one) == len(two)
        differ = sum(bin(x & (1 << 64) - 1).count("1") for x in (one ^ two).tolist())
        assert differ <= len(np.setxor1d(a, b))


def test_texts_that_share_a_common_line_only_are_not_told_against_a_lead(spark, monkeypatch):
    """More texts of a shingle than are paired at once; only copies among them have a partner."""
    rng, told = random.Random(11), []
    text = lambda n: [f"w{rng.randrange(10 ** 6)}" for _ in range(n)]
    line = text(40)
    rows = [(i, " ".join(text(80) + line)) for i in range(150)]
    rows += [(150 + i, t.replace(t.split()[70], "x")) for i, t in rows[:3]]
    lookup = near_copies._Texts.told

    def counted(texts, pairs, say):
        told.append(pairs.count())
        return lookup(texts, pairs, say)

    monkeypatch.setattr(near_copies._Texts, "told", counted)
    # No shingle is known to be common.
    monkeypatch.setattr(near_copies, "_common", lambda sets: (np.array([], np.int64),) * 2)
    df = spark.createDataFrame([(i, t, "en", "a", 0) for i, t in rows], DOCS).repartition(4)
    got = sorted(r.doc_id for r in near_copies.keep_first(df).collect())
    assert got == sorted(kept_ids(rows)) == list(range(150))
    assert sum(told) <= 20


def test_partners_are_all_that_may_be_like_another(monkeypatch):
    """Sizes on both sides of a power of two, in small blocks too: no similar pair goes."""
    rng = np.random.default_rng(4)
    base, sets = [rng.integers(-2 ** 63, 2 ** 63 - 1, n) for n in (40, 62, 70, 300)], []
    for own in base:
        for cut in (0, 1, 3, 6, 20):
            sets.append(np.unique(np.append(own[cut:], rng.integers(-2 ** 63, 2 ** 63 - 1, 2 * (cut == 3)))))
    sets += [rng.integers(-2 ** 63, 2 ** 63 - 1, n) for n in (40, 62, 70, 300, 33, 128)]
    n, root = np.array([len(s) for s in sets]), np.arange(len(sets))
    bits = [near_copies._parities(s) for s in sets]
    width = np.array([len(b) for b in bits])
    like = [any(i != j and 5 * len(np.intersect1d(a, b)) >= 4 * len(np.union1d(a, b))
                for j, b in enumerate(sets)) for i, a in enumerate(sets)]
    for words in (near_copies.WORDS, 50):
        monkeypatch.setattr(near_copies, "WORDS", words)
        held = np.concatenate(bits).view(np.uint64)
        hit = near_copies._may_meet(n, 0 * n, root, np.cumsum(width), width, held, 0.8)
        assert not (np.array(like) & ~hit).any() and not hit[-6:].any() and len(set(width)) > 2
        assert not near_copies._may_meet(n, 0 * n, 0 * root, np.cumsum(width), width, held, 0.8).any()


def test_rows_of_a_shingle_over_several_batches_find_their_partners():
    """As all pairs say by their parities, negative words among them."""
    import pyarrow as pa

    rng, rows = np.random.default_rng(6), []
    for h in range(40):
        base = rng.integers(-2 ** 63, 2 ** 63 - 1, 90)
        for k in range(rng.integers(1, 9)):
            own = np.unique(np.append(base[rng.integers(0, 30):], rng.integers(-2 ** 63, 2 ** 63 - 1, 5)))
            rows.append((h, len(rows), len(own), int(rng.integers(0, 9)), int(rng.integers(0, 2)),
                         near_copies._parities(own).tolist()))
    want = set()
    for a in rows:
        for b in rows:
            n, both = a[2] + b[2], -(-4 * (a[2] + b[2]) // 9)
            if len(a[5]) == len(b[5]):
                differ = sum(bin((x ^ y) & (1 << 64) - 1).count("1") for x, y in zip(a[5], b[5]))
                if a[0] == b[0] and a[4] != b[4] and n - differ >= 2 * both and 5 * min(a[2], b[2]) >= 4 * max(
                        a[2], b[2]) and min(a[2] - a[3], b[2] - b[3]) >= both:
                    want |= {a[1], b[1]}
    assert len({len(r[5]) for r in rows}) == 1 and 10 < len(want) < len(rows) - 10
    schema = pa.schema([("h", pa.int64()), ("node", pa.int64()), ("n", pa.int32()), ("place", pa.int32()),
                        ("root", pa.int64()), ("bits", pa.list_(pa.int64()))])
    table = pa.Table.from_pylist([dict(zip(schema.names, r)) for r in rows], schema)
    for size in (7, 1000):
        got = near_copies._partners(0.8)(iter(table.to_batches(max_chunksize=size)))
        assert {x for b in got for x in b.column(1).to_pylist()} == want
