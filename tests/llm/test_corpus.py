"""Sharding, mixing, SimHash, token records, WARC, substring dedup and the pipeline."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from feedloom.llm import (
    automaton, components, files, mixing, sharding, simhash, substrings, token_records, tokens, warc)
from feedloom.llm.queries import TOKENIZER
from feedloom.session import scratch_dir

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return WORD.findall(text or "")


def corpus(spark, n=160, seed=4, extra=()):
    rng = random.Random(seed)
    lex = [f"w{i}" for i in range(300)] + ["Ünï", "𝄞", "x.", "y,"]
    text = lambda k: " ".join(rng.choice(lex) for _ in range(k))
    passage = text(60)
    rows = []
    for i in range(n):
        t = text(rng.choice([0, 1, 3, 19, 20, 25, 80, 300]))
        if i % 7 == 0:
            t += "\n" + passage + " " + text(5)
        if i % 11 == 0 and rows:
            t = rows[rng.randrange(len(rows))][1]
        rows.append((i * 3, t, "en", rng.choice(["a", "b", "é", None]), 0))
    rows += [(1000, None, "de", "a", None), (1001, "", None, None, 1), (1002, "z " * 30_000, "x", "big", 1)]
    rows += list(extra)
    rng.shuffle(rows)
    return rows, spark.createDataFrame(rows, DOCS).repartition(5)


def test_shards_are_near_equal_and_gapless(spark):
    rows, df = corpus(spark, extra=[(9, "copy " * 40, "l", "a", 1)] * 3 + [(None, "no id", "l", "a", 1)])
    df = df.withColumns({"shard": F.lit("x"), "key": F.lit(1), "part": F.lit(2)})
    out = sharding.write_shards(df, scratch_dir(spark, "t"), shards=5)
    got = out.collect()
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == want
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        sizes[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean, widest = sum(sizes.values()) / 5, 60_001
    assert all(abs(s - mean) <= widest for s in sizes.values()) and set(sizes) <= set(range(5))


def test_splitters_cut_a_hot_text_by_id(spark):
    rows = [(i, "the same text " * 10) for i in range(3000)] + [(i, f"t{i} " * 30) for i in range(3000, 4000)]
    narrow = sharding.keyed(spark.createDataFrame(rows, "doc_id long, text string")).persist()
    bounds = sharding.splitters(narrow, 8)
    by = narrow.groupBy(sharding.shard_of(F.col("key"), F.col("doc_id"), bounds).alias("s")).agg(F.sum("size"))
    sizes = [r[1] for r in by.collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) < 2 * .002 * sum(sizes) / 8 + 300


def test_shards_of_nothing(spark):
    _, df = corpus(spark)
    assert sharding.write_shards(df.limit(0), scratch_dir(spark, "t")).count() == 0
    assert sharding.write_shards(df.limit(1), scratch_dir(spark, "t")).count() == 1


def test_shards_keep_the_callers_columns(spark):
    """Columns that bear the job's own names, and an id that is not called doc_id."""
    names = ["key", "part", "at", "first", "doc_id", "a.b"]
    rows = [(i, f"text {i % 7}", *[f"{n}{i}" for n in names]) for i in range(40)]
    df = spark.createDataFrame(rows, ", ".join(["id long", "body string", *[f"`{n}` string" for n in names]]))
    df = df.withColumn("slot", F.lit(-1))
    out = sharding.write_shards(df, scratch_dir(spark, "t"), shards=3, doc_id="id", text="body")
    assert out.columns == ["id", "body", *names, "size", "text_crc32", "slot", "shard"]
    got = [tuple(r) for r in out.collect()]
    assert sorted(r[:8] for r in got) == sorted(rows) and {r[-1] for r in got} == {0, 1, 2} and min(r[-2] for r in got) == 0


def plain_targets(sizes, share=1.5, cap=2.0):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    out, free = {}, list(names)
    while free:
        left = share * sum(sizes.values()) - sum(out.values())
        w = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > cap * sizes[s]]
        if not over:
            return out | {s: left * weight[s] / w for s in free}
        out |= {s: cap * sizes[s] for s in over}
        free = [s for s in free if s not in over]
    return out


def mixed(df, **how):
    sized = mixing.with_sizes(df)
    cells, shards = mixing.quotas(sized, **how)
    return mixing.mix(sized, cells, shards, tie=F.xxhash64("text"))


def test_mix_meets_its_targets(spark):
    rows, df = corpus(spark, n=400)
    df = df.withColumns({"_shard": F.lit(3), "target": F.lit("x"), "taken": F.lit(None)})
    got = mixed(df, block=8).collect()
    sizes = Counter()
    for _, t, _, s, _ in rows:
        sizes[s] += len(words(t))
    want, taken = plain_targets(sizes), Counter()
    for r in got:
        assert r["size"] == len(words(r.text)) and 0 <= r.taken <= 2 * r["size"]
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        taken[r.source] += r.taken
    assert len(got) == len(rows)
    assert all(abs(taken[s] - want[s]) <= .02 * want[s] + 16 for s in sizes), (taken, want)
    again = mixed(df.repartition(3), block=8).collect()
    assert Counter((r.doc_id, r.taken) for r in got) == Counter((r.doc_id, r.taken) for r in again)


def test_taken_texts_hold_the_taken_words(spark):
    rows, df = corpus(spark, n=200, extra=[(3, "dup x y z", "a", "a", 1)] * 2)
    own = mixed(df, block=8).persist()
    taken, whole = Counter(), {t for _, t, *_ in rows}
    for r in own.collect():
        taken[r.doc_id] += r.taken
    texts = Counter()
    more = mixed(df, block=8, share=2.9, cap=3.0).persist()
    owed = more.agg(F.sum("taken")).first()[0]
    assert owed == sum(len(words(r.text)) for r in mixing.take(more).collect())
    assert more.filter("taken > 2 * size").count() > 0
    for r in mixing.take(own).collect():
        assert words(r.text) and (r.text == r.text.lstrip(" \n") or r.text in whole)
        texts[r.doc_id] += len(words(r.text))
    assert texts == +taken
    assert mixed(df.limit(0)).count() == 0


def test_sainte_lague_by_quotients(spark):
    rng = random.Random(8)
    for seats in (0, 1, 17, 240):
        weights = [rng.choice([0.0, .3, rng.uniform(0, 40)]) for _ in range(12)]
        df = spark.createDataFrame([(i, w) for i, w in enumerate(weights)], "p int, ideal double")
        if seats == 240:
            df, weights = df.withColumn("ideal", F.col("ideal") * 3), [3 * w for w in weights]
        seats = seats if seats < 240 else round(sum(weights))
        near = sum(int(w + .5) for w in weights)
        if abs(near - seats) > len(weights):
            continue  # seats are always the rounded sum of the weights
        lots = sorted(((w / (2 * k + 1), -i) for i, w in enumerate(weights) if w for k in range(200)),
                      reverse=True)[:seats]
        got = mixing.sainte_lague(df, [F.col("p")], [], F.lit(seats)).collect()
        assert {r.p: r.quota for r in got} == {i: sum(-j == i for _, j in lots) for i in range(12)}


def test_simhash_classes_match_all_pairs(spark):
    rng = random.Random(6)
    rows, df = corpus(spark, n=120)
    base = "alpha beta gamma delta " * 40 + " ".join(f"v{i}" for i in range(300))
    more = []
    for i in range(60):
        w = base.split()
        for _ in range(i % 4):
            w[rng.randrange(len(w))] = f"x{rng.random()}"
        more.append((5000 + i, " ".join(w), "a", "a", 0))
    more += [(7000, "One two", "", "", 0), (6999, "one TWO", "", "", 0)]
    df = df.union(spark.createDataFrame(more, DOCS)).withColumn("fp", F.lit("x"))
    texts = {i: t for i, t, *_ in rows + more}
    fp = {i: simhash.fingerprint(t) for i, t in texts.items()}
    ids, root = sorted(fp), {}
    for i in ids:
        if i in root:
            continue
        todo = [i]
        while todo:
            x = todo.pop()
            root[x] = i
            todo += [y for y in ids if y not in root and y not in todo and (fp[x] ^ fp[y]).bit_count() <= 3]
    got = simhash.classes(df).collect()
    assert {r.doc_id: (r.fp % (1 << 64), r.component_id) for r in got} == {
        i: (fp[i], root[i]) for i in ids}
    kept = simhash.keep_first(df.withColumn("_later", F.lit(1)))
    assert {r.doc_id for r in kept.collect()} == set(root.values())
    assert simhash.classes(df.limit(0)).count() == 0


def test_links_are_all_pairs_within_three_bits(spark):
    rng = random.Random(1)
    fps = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(40):
        x = rng.getrandbits(64)
        fps.add(x)
        for k in (1, 2, 3, 4):
            y = x
            for bit in rng.sample(range(64), k):
                y ^= 1 << bit
            fps.add(y)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = {frozenset((r.a % (1 << 64), r.b % (1 << 64))) for r in simhash.links(
        spark.createDataFrame([(x,) for x in signed], "fp long")).collect()}
    assert got == {frozenset((x, y)) for x in fps for y in fps if 0 < (x ^ y).bit_count() <= 3}


def test_components_of_paths_stars_and_repeats(spark):
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, x) for x in range(8, 30)] + [(50, 50), (60, 61)] * 3
    edges += [(None, 3), (61, 62), (62, 60)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 141)} | {i: 7 for i in range(7, 30)} | {
        60: 60, 61: 60, 62: 60}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


HARD = ["it's, don't. I'LL,.", "<|endoftext|>.", "a<|startoftext|>b", "İstanbul ΑΣ. ﬁ", "é ́x",
        "1,234.50", "..., .", "x y z ", "\x1ca\x1f", "日本語。テスト", "😀😀,", "", None, "A" * 3000]


def test_word_encoder_equals_whole_text_encoding():
    t = Tokenizer.from_file(TOKENIZER)
    for limit in (5, 10_000):
        e = tokens.WordEncoder(TOKENIZER, limit)
        for texts in (HARD, HARD[::-1], [" ".join(x for x in HARD if x)], []):
            got = [np.frombuffer(b, e.dtype).tolist() for b in e.encode(texts, chunk=7)]
            assert got == [t.encode(x or "", add_special_tokens=False).ids for x in texts]


def test_token_files_round_trip(spark):
    rows, df = corpus(spark, extra=[(None, "no id", "", "", 0), (6, "again", "", "", 0), (6, "again", "", "", 0)])
    df = df.withColumn("file", F.lit(1))
    folder = scratch_dir(spark, "t")
    manifest = token_records.write(df, folder, TOKENIZER)
    got = token_records.read(manifest, folder, with_ids=True).collect()
    t = Tokenizer.from_file(TOKENIZER)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    at = 0
    for r, (i, text, *_) in zip(sorted(got, key=lambda r: r.start), order, strict=True):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (i, at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    f = max(manifest.collect(), key=lambda f: f.records)
    inside = sorted((r for r in got if f.first_token <= r.start < f.first_token + f.tokens),
                    key=lambda r: r.start)
    for k in (0, f.records // 2, f.records - 1):
        doc, ids = token_records.read_record(folder, f.file, k)
        assert (doc, ids.tolist()) == (inside[k].doc_id, inside[k].ids)
    empty = scratch_dir(spark, "t")
    assert token_records.read(token_records.write(df.limit(0), empty, TOKENIZER), empty).count() == 0


def test_token_files_notice_damage(spark):
    _, df = corpus(spark, n=20)
    folder = scratch_dir(spark, "t")
    manifest = token_records.write(df, folder, TOKENIZER)
    f = manifest.first()
    fs, root = files.open_fs(f"{folder}/data")
    with open(f"{root}/{f.file}.rec", "r+b") as data:
        data.seek(f.bytes - 6)
        data.write(b"\xff\xff")
    with pytest.raises(Exception, match="checksum"):
        token_records.read(manifest, folder).collect()


def test_warc_round_trip(spark):
    page = "<p>é𝄞\r\n\r\n</p>" * 40
    rows = [(5, "http://a/\r\nX: y", page, 1), (3, "http://b/", page, 1), (9, None, page, 1), (9, None, page, 1),
            (1, "http://c/", "short", 1), (2, "u", "short", 1), (4, "u", None, 1), (6, "u", "", 1),
            (None, "n", page, 1), (7, "big", "z" * 3_000_000, 1), (8, "w", "w" * 100, 1), (10, "w", "w" * 100, 1)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, offset int")
    folder = scratch_dir(spark, "t")
    index = warc.write(df, folder)
    got = warc.read(index, folder, with_payload=True).collect()
    first = {}
    for i, _, h, _ in rows:
        if h and len(h) >= 100 and i is not None:
            first[h] = min(i, first.get(h, i))
    want = Counter()
    for i, _, h, _ in rows:
        data = (h or "").encode()
        later = i is not None and h in first and i > first[h]
        want[i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if later else "response",
             first[h] if later else None, b"" if later else data] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                    bytes(r.payload)) for r in got) == want
    some = warc.read(index.filter("page_id IN (7, 2)"), folder).collect()
    assert {r.page_id for r in some} == {7, 2}
    empty = scratch_dir(spark, "t")
    assert warc.read(warc.write(df.limit(0), empty), empty).count() == 0


def plain_dedupe(rows, width):
    docs = sorted((i, words(t)) for i, t, *_ in rows)
    first, out = {}, {}
    for i, w in docs:
        for p in range(len(w) - width + 1):
            first.setdefault(tuple(w[p:p + width]), (i, p))
    for i, w in docs:
        gone = {q for p in range(len(w) - width + 1) if first[tuple(w[p:p + width])] != (i, p)
                for q in range(p, p + width)}
        out[i] = (len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))
    return out


def test_substring_dedup_matches_brute_force(spark, monkeypatch):
    rows, df = corpus(spark, n=220)
    for settings in ({}, {"GROUP": 7, "SHARD_WORDS": 50, "PIECE_WORDS": 33, "FLUSH": 40, "HELD_WORDS": 100}):
        for k, v in settings.items():
            monkeypatch.setattr(substrings, k, v)
        found = substrings.dedupe(df.withColumns({"h": F.lit(1), "blk": F.lit("x")})).collect()
        got = {r.doc_id: (r.n_words, sum(s.length for s in r.removed), r.kept) for r in found}
        assert got == plain_dedupe(rows, 20) and len(found) == len(rows)
        for r in found:  # spans are maximal
            assert all(a.start + a.length < b.start for a, b in zip(r.removed, r.removed[1:]))


def test_substring_dedup_of_repeated_rows_and_nothing(spark):
    w = " ".join(f"k{i}" for i in range(30))
    df = spark.createDataFrame([(1, w), (1, w), (2, w), (None, "q " + w), (3, None)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.kept) for r in substrings.dedupe(df).collect()))
    assert got == [(0, "q " + w), (1, ""), (1, ""), (2, ""), (3, "")]
    assert substrings.dedupe(df.limit(0)).count() == 0


def test_automaton_finds_the_first_place():
    rng = random.Random(2)
    for _ in range(30):
        passages = [[rng.choice("abc").encode() for _ in range(rng.randint(0, 30))] for _ in range(5)]
        stream = [rng.choice("abcd").encode() for _ in range(60)]
        auto = automaton.SuffixAutomaton(passages)
        flat = [x for p in passages for x in (*p, None)]
        want = []
        for i in range(3, 60):
            run = stream[i - 3:i + 1]
            ends = [e for e in range(3, len(flat)) if flat[e - 3:e + 1] == run]
            if ends:
                want.append((i, ends[0]))
        assert list(auto.matches(stream, 4)) == want


def test_pipeline_against_its_operators(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    own = {r.doc_id: r.text for r in docs.collect()}
    n, after = len(own), docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, after, sf).write.parquet(path)
        after = spark.read.parquet(path)
        assert tuple(after.columns) == corpus_pipeline.COLUMNS
        assert 0 < after.count() <= n * 2
    for r in after.collect():
        assert all(w in own[r.doc_id] for w in words(r.text)[:50]) and r.n_chars == len(r.text)
    t = Tokenizer.from_file(TOKENIZER)
    want = Counter((r.doc_id, len(t.encode(r.text, add_special_tokens=False).ids) + 1) for r in after.collect())
    got = corpus_pipeline.STAGES[-1][1](spark, after, sf).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == want
    assert corpus_pipeline.run(spark, sf).count() == sum(want.values())
