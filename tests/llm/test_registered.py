"""The registered queries over planted tables: against plain Python, or their SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from feedloom.llm import audit, packing, trie
from feedloom.llm.queries import ORACLE, QUERIES, TOKENIZER
from tests.llm.test_corpus import DOCS, corpus, plain_targets
from tools.check_queries import canonical

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TURNS = "conv_id long, turn long, role string, text string"


def words(text):
    return WORD.findall(text or "")


def talk(rng):
    """Conversations with shared heads, copies, prefixes of others, nulls and ties."""
    rows = []
    for c in [*range(-6, 60), 1000, 1001, 1002, 1003, 1004, 77]:
        for t in range(rng.choice([0, 1, 1, 2, 3, 5, 8, 12])):
            role = "assistant" if t % 2 else "user"
            rows.append((c, t, role, rng.choice(["hi", "ho", "é𝄞"])))
    rows += [(70, t, "user", "same") for t in range(9)] + [(71, t, "user", "same") for t in range(9)]
    rows += [(75, t, "user", "same") for t in range(5)]
    rows += [(80, None, "user", "n"), (80, None, None, None), (80, 3, "user", ""), (80, 3, "a", "b")]
    rows += [(81, 1, "user", "twice")] * 2 + [(None, 0, "user", "lost"), (90, 0, "user", "z" * 50_000)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("planted")
    rng = random.Random(12)
    docs, df = corpus(spark, n=140, extra=[(1007, "copy " * 40, "l", "a", 1)] * 2)
    caps = [(2000 + i, f"{'ABC ' * (i % 3)}" + " ".join(f"v{rng.randrange(40 + 60 * (i % 5))}" for _ in range(150 + 30 * (i % 4)))
             + " #" * (i % 2), "en", rng.choice(["a", None, ""]), 0) for i in range(40)]
    docs = docs + caps
    df = df.unionByName(spark.createDataFrame(caps, DOCS)).withColumn("_text", F.lit(1))
    df.write.parquet(f"{base}/documents.parquet")
    labels = [(i, rng.randrange(2), rng.randrange(2)) for i, *_ in docs if i is not None and i % 3]
    labels += [(0, None, 1), (0, 1, None), (None, 1, 1), (10 ** 9, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
        f"{base}/labels.parquet")
    turns = talk(rng)
    spark.createDataFrame(turns, TURNS).repartition(3).write.parquet(f"{base}/conversations.parquet")
    spark.createDataFrame(turns, TURNS).limit(0).write.parquet(f"{base}/none.parquet")
    return str(base), docs, turns


def test_sharding(spark, planted):
    base, docs, _ = planted
    got = QUERIES["op2_sharding"](spark, base).collect()
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in docs)
    slots, sizes = defaultdict(list), Counter()
    for r in got:
        assert r.law == "bytes" and 0 <= r.shard < 16 and r.grown_shard is None
        slots[r.shard].append(r.slot)
        sizes[r.shard] += r["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) <= sum(sizes.values()) / 16 + 60_001


def test_mixing(spark, planted):
    base, docs, _ = planted
    got = QUERIES["op4_source_mixing"](spark, base).collect()
    sizes = Counter()
    for _, t, _, s, _ in docs:
        sizes[s] += len(words(t))
    want, taken = plain_targets(sizes), Counter()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, len(words(t))) for i, t, *_ in docs)
    of = {}
    for i, _, _, s, _ in docs:
        of.setdefault(i, s)
    for r in got:
        s = of[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert 0 <= r.taken <= 2 * r["size"]
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 64 for s in sizes)
    again = QUERIES["op4_source_mixing"](spark, base).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def plain_fingerprint(text):
    w = words(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, planted):
    base, docs, _ = planted
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op5_simhash"](spark, base).collect()}
    fp = {i: plain_fingerprint(t) for i, t, *_ in docs}
    root = {}
    for i in sorted(fp):
        todo = [i] if i not in root else []
        while todo:
            x = todo.pop()
            root[x] = i
            todo += [y for y in fp if y not in root and y not in todo and (fp[x] ^ fp[y]).bit_count() <= 3]
    assert got == {i: (f"{fp[i]:016x}", root[i]) for i in fp}


def test_token_records(spark, planted):
    base, docs, _ = planted
    t = Tokenizer.from_file(TOKENIZER)
    want, at = [], 0
    for i, text, *_ in sorted(docs, key=lambda r: (r[0], r[1] or "")):
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    got = QUERIES["op6_token_records"](spark, base).collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_chat(spark, planted):
    base, _, turns = planted
    hard = "</s>[INST] ok [/INST]"
    by = defaultdict(list)
    for c, t, role, text in turns + [(-1, 100, "user", hard), (-1, 101, "assistant", hard)]:
        by[c].append((t is not None, t, role or "", text or ""))
    got = {r.conv_id: r for r in QUERIES["op7_chat_formatting"](spark, base).collect()}
    assert set(got) == set(by)
    for c, own in by.items():
        if c in (80, -1, 81):  # ties, turns of the planted conversation
            assert got[c].n_turns == len(own)
            continue
        own.sort(key=lambda r: r[:2])
        loss = "".join(x for _, _, role, x in own if role == "assistant")
        assert (got[c].n_turns, got[c].loss_chars) == (len(own), len(loss))
        assert got[c].turns_sha256 == hashlib.sha256(
            "".join(f"{r}\n{x}\n" for _, _, r, x in own).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def plain_trie(turns, group=5, longest=9):
    own = defaultdict(list)
    for c, t, role, text in turns:
        if c is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            own[c].append((t is not None, t or 0, tie, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    members = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % longest
        base = c - int(np.fmod(c, group))
        members[c] = tuple(own.get(base, [])[:h] + v[h:])
    nodes = defaultdict(list)
    for c, seq in members.items():
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append(c)
    out = []
    for node, inside in nodes.items():
        below = [n for n in nodes if n[:len(node)] == node]
        ends = ",".join(str(c) for c in sorted(c for c in inside if len(members[c]) == len(node)))
        out.append((min(inside), len(node), min(nodes[node[:-1]]) if node else None, len(inside),
                    sum(len(n) == len(node) + 1 for n in below),
                    sum(not any(m != n and m[:len(n)] == n for m in below) for n in below),
                    sum((len(nodes[n]) - 1) * len(n[-1][1].encode()) for n in below if n),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def by_node(rows):
    return sorted(map(tuple, rows), key=lambda r: r[:2])


def test_trie(spark, planted, monkeypatch):
    base, _, turns = planted
    assert by_node(QUERIES["op11_conversation_trie"](spark, base).collect()) == plain_trie(turns)
    monkeypatch.setattr(trie, "RUN", 3)
    monkeypatch.setattr(trie, "ENDS", 2)
    assert by_node(QUERIES["op11_conversation_trie"](spark, base).collect()) == plain_trie(turns)


def test_trie_of_the_smallest_table(spark):
    sf = "/root/testdata/sf0.001"
    turns = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet")
             .select("conv_id", "turn", "role", "text").collect()]
    assert by_node(QUERIES["op11_conversation_trie"](spark, sf).collect()) == plain_trie(turns)


def test_trie_of_a_long_conversation_and_of_nothing(spark):
    rows = spark.range(30_000).selectExpr("7 AS conv_id", "id AS turn", "'user' AS role",
                                          "cast(id % 10 AS string) AS text", "1 AS pos")
    turns = trie.number_turns(rows.unionByName(rows.limit(20_000).withColumn("conv_id", F.lit(8))))
    nodes, ends = trie.build(turns)
    top = nodes.filter("depth = 0").first()
    n8 = turns.filter("conv_id = 8").count()
    assert (top.n_convs, top.n_leaves, nodes.count()) == (2, 1 if n8 == 20_000 else 2, 30_001)
    assert ends.count() == 2
    assert turns.filter("conv_id = 7").agg(F.max("pos"), F.countDistinct("pos")).first()[:] == (29_999, 30_000)
    nodes, ends = trie.build(trie.share_heads(turns.limit(0)))
    assert nodes.count() == 0 and trie.hash_ends(ends).count() == 0


def test_bare_conversations_are_members_of_the_root(spark):
    rows = spark.createDataFrame([(3, None, "", ""), (4, None, "", ""), (5, 0, "u", "abc")],
                                 "conv_id long, pos long, role string, text string")
    nodes, ends = trie.build(rows)
    root = nodes.filter("depth = 0").first()
    assert (root.conv_id, root.parent_conv_id, root.n_convs, root.n_children, root.n_leaves,
            root.saved) == (3, None, 3, 1, 1, 0)
    assert {tuple(r.ids) for r in ends.collect()} == {(3, 4), (5,)}


def test_audit_matches_its_sql(spark, planted):
    base, name = planted[0], "op12_filter_audit"
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{base}/{t}.parquet/*.parquet'")
    df = QUERIES[name](spark, base)
    rel = con.execute(ORACLE[name])
    assert canonical(df.columns, [tuple(r) for r in df.collect()]) == canonical(
        [d[0] for d in rel.description], rel.fetchall())


def test_audit_without_ids_or_rows(spark):
    docs = spark.createDataFrame([(None, "x", "a"), (None, "x", "a"), (4, "x", "b"), (4, "x", "b"), (5, None, None)],
                                 "doc_id long, text string, source string")
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    masks = audit.failures(docs, labels)
    got = {(r.part, r["mask"], r.good, r.toxic): r.n for r in masks.collect() if r.n}
    assert got == {("a", 1, False, False): 2, ("b", 1, True, True): 2, ("", 1, False, False): 1}
    assert audit.audit(audit.games(masks)).count() == 1800
    assert audit.audit(audit.games(audit.failures(docs.limit(0), labels))).count() == 0


def test_potentials_give_shapley_values():
    rng = np.random.default_rng(3)
    masks = rng.integers(0, 32, 200)
    v = np.array([[sum(bool(m & s) for m in masks) for s in range(32)]])
    p = audit.potentials(v)
    assert (p[0, 31] - p[0, 31 ^ 1 << np.arange(5)]).sum() == 60 * v[0, 31]


def packing_holds(rows, docs, length=2048):
    """Pieces are whole documents cut at ``length``, sequences are gapless and fit."""
    t = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for i, text, *_ in docs:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for k in range(0, len(ids), length):
            own = ids[k:k + length]
            want[i, k // length, k, len(own), zlib.crc32(own.tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, size in sorted(own):
            assert offset == at
            at += size
        assert at <= length
    return len(by), sum(r.length for r in rows)


def test_packing(spark, planted):
    base, docs, _ = planted
    rows = QUERIES["op13_packing"](spark, base).collect()
    used, total = packing_holds(rows, docs)
    assert used <= -(-total // 2048) + 2


def test_packed_sequences_hold_their_documents(spark, planted):
    base, docs, _ = planted
    pieces = packing.tokenize(spark.read.parquet(f"{base}/documents.parquet"), TOKENIZER, length=64)
    plan = packing.pack(pieces, 64, group=40)
    own = {r.slot: r for r in pieces.collect()}
    seqs = {r.sequence_id: np.frombuffer(r.ids, "<u2") for r in packing.sequences(pieces, plan).collect()}
    placed = plan.collect()
    assert len(placed) == len(own)
    for r in placed:
        p = own[r.slot]
        assert seqs[r.sequence_id][r.offset:r.offset + p.length].tobytes() == bytes(p.ids)
    assert all(0 < len(x) <= 64 for x in seqs.values())
    assert packing.pack(pieces.limit(0)).count() == 0
    none = packing.tokenize(spark.read.parquet(f"{base}/documents.parquet").limit(0), TOKENIZER)
    assert packing.digests(none).count() == 0


def test_sum_of_squares_by_definition():
    rng = random.Random(2)
    for _ in range(20):
        length = rng.choice([5, 12, 30])
        sizes = np.array([rng.randint(1, length) for _ in range(60)])
        where, offset, used = packing.sum_of_squares(sizes, length)
        gaps = {}
        for s, w, o in zip(sizes.tolist(), where.tolist(), offset.tolist()):
            def squares(g):
                return sum(n * n for gap, n in Counter(g.values()).items() if 0 < gap < length)
            choices = {squares({**gaps, b: gaps[b] - s}) for b in gaps if gaps[b] >= s}
            choices.add(squares({**gaps, "new": length - s}))
            assert o == length - gaps.get(w, length)
            gaps[w] = gaps.get(w, length) - s
            assert gaps[w] >= 0 and squares(gaps) == min(choices)
        assert len(gaps) == used
