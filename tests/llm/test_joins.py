"""Prefix trie, spelling variants and the Jaccard join against brute force."""

import hashlib
import itertools
import os
import random
import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from labelqa.llm import count_min, jaccard_join, prefix_trie, queries, spelling_variants

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def same_as_sql(spark, name, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    found = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLE[name])
    names = [d[0] for d in want.description]
    assert sorted(found.columns) == sorted(names)
    assert sorted(map(repr, (tuple(r[c] for c in names) for r in found.collect()))) == sorted(map(repr, map(tuple, want.fetchall())))


# ------------------------------------------------------------------ 11

TALK = "conv_id long, turn long, role string, text string, conv long, depth long, mark string, part string, n string"


def talk(spark, rows):
    return spark.createDataFrame([(*r, 7, 8, "x", "y", "z") for r in rows], TALK)


def brute_trie(rows, rebuild=True):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            said[conv].append((turn is not None, turn or 0, mark, role, text))
    said = {c: [t[3:] for t in sorted(ts)] for c, ts in said.items()}
    full = {}
    for c, ts in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20) * (1 if c >= 0 else -1)
        full[c] = tuple(said.get(base, [])[:h] + ts[h:]) if rebuild else tuple(ts)
    members = defaultdict(list)
    for c, ts in full.items():
        for d in range(len(ts) + 1):
            members[ts[:d]].append(c)
    kids = defaultdict(set)
    for node in members:
        if node:
            kids[node[:-1]].add(node)
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += (len(who) - 1) * len(WORD.findall(node[-1][1])) if node else 0
    out = []
    for node, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if len(full[c]) == len(node)))
        out.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), len(kids[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(spark, rows, **kw):
    turns = prefix_trie.numbered(prefix_trie.turn_marks(talk(spark, rows)))
    nodes = prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns), **kw)
    return sorted(map(tuple, nodes.collect()), key=repr)


def random_talk(seed, convs=120, words=3):
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-40, 400), convs):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t % 2 else "user", rng.choice(["a", "b b", "c c c"][:words])))
    return rows


def test_trie_equals_brute_force(spark):
    rows = random_talk(1) + [(600 + i, t, "user", "same") for i in range(60) for t in range(4)]
    rows += [(None, 1, "user", "no conversation"), (900, None, None, None), (900, 3, "user", "x"), (900, 3, "user", "x"), (900, 3, "tool", ""), (901, 0, "user", "only turn")]
    rows += [(2000, t, "user", f"turn {t % 3} " + "word " * (t % 5)) for t in range(300)]
    assert trie(spark, rows) == brute_trie(rows)


def test_trie_with_collisions_and_chunks(spark, monkeypatch):
    """A full sketch proves nothing and chunks of three turns: same nodes."""
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = random_talk(2) + [(c, t, "user", "long") for c in (800, 803, 811) for t in range(40 + c % 2)]
    want = brute_trie(rows)
    assert trie(spark, rows) == want
    monkeypatch.setattr(prefix_trie, "screen", lambda rows, most: (lambda a, b: prefix_trie.F.lit(True)))
    assert trie(spark, rows) == want


def test_trie_false_alarms_below_a_singleton(spark, monkeypatch):
    """Prefixes that seem shared although a shorter one is proven single."""
    rows = random_talk(3, convs=60) + [(c, t, "user", f"{c} {t}") for c in range(500, 540) for t in range(9)]
    real = prefix_trie.screen

    def noisy(table, most):
        may = real(table, most)
        return lambda a, b: may(a, b) | (prefix_trie.F.pmod(prefix_trie.F.xxhash64(a, b, prefix_trie.F.lit(1)), prefix_trie.F.lit(3)) == 0)

    monkeypatch.setattr(prefix_trie, "screen", noisy)
    assert trie(spark, rows) == brute_trie(rows)


def test_trie_without_rows(spark):
    assert trie(spark, []) == []


def test_end_digests_split_long_lists(spark):
    ids = list(range(20_000, 0, -1))
    ends = spark.createDataFrame([(1, 2, i) for i in ids] + [(1, 3, -5), (1, 3, 4)], "k1 long, k2 long, conv long")
    want = {2: ",".join(map(str, sorted(ids))), 3: "-5,4"}
    assert {r["k2"]: r["sha"] for r in prefix_trie.end_digests(ends).collect()} == {k: hashlib.sha256(v.encode()).hexdigest() for k, v in want.items()}


@needs_tables
def test_trie_sql(spark):
    same_as_sql(spark, "op11_prefix_trie", ["conversations"])


# ------------------------------------------------------------------ 12

VOCAB = "word string, n long, cell long, slot long, best string, root string"


def edited(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_variants(vocab):
    near = {w: [v for v in vocab if abs(len(v) - len(w)) < 2 and edited(w, v)] for w in vocab}
    form = {}
    for w, n in vocab.items():
        best = min(near[w], key=lambda v: (-vocab[v], v), default=None)
        form[w] = best if best is not None and vocab[best] >= 5 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted(((w, form[w], root(w), vocab[w], len(near[w]), None if form[w] is None else vocab[form[w]]) for w in vocab), key=repr)


def some_words(seed, alphabet="abcé", sizes=(6, 9), many=250):
    rng = random.Random(seed)
    out = {}
    while len(out) < many:
        w = "".join(rng.choice(alphabet) for _ in range(rng.randint(*sizes)))
        out[w] = 5 ** rng.randint(1, 6) + rng.randint(0, 1)
        if rng.random() < 0.5:
            i = rng.randrange(len(w))
            out[w[:i] + rng.choice(alphabet) + w[i + rng.randint(0, 1):]] = rng.choice([5, 26, 130])
    return out


def variants_of(spark, vocab, **sizes):
    df = spark.createDataFrame([(w, n, 1, 2, "x", "y") for w, n in vocab.items()], VOCAB)
    return sorted(map(tuple, spelling_variants.variants(df, **sizes).collect()), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"cell": 8}, {"cell": 8, "sample": 40}, {"cell": 1, "held": 30}])
def test_variants_equal_brute_force(spark, sizes, monkeypatch):
    monkeypatch.setattr(spelling_variants, "LEAF", 4)
    vocab = some_words(len(sizes)) | {"x" * 70: 6, "x" * 69: 40, "x" * 69 + "y": 900, "zz" * 40_000: 5, "zz" * 40_000 + "z": 50}
    vocab |= {w: 5 + i for i, w in enumerate(["abccba", "bacabc", "cabcab", "aabbcc"])}      # one vector, many orders
    assert variants_of(spark, vocab, **sizes) == brute_variants(vocab)


def test_variants_chain_and_ties(spark):
    vocab = {"aaaaaa": 5, "aaaaab": 25, "aaaabb": 125, "aaabbb": 625, "caaaaa": 25, "lonely": 9}
    rows = {r[0]: r[1:] for r in variants_of(spark, vocab)}
    assert rows["aaaaaa"][:2] == ("aaaaab", "aaabbb")
    assert rows["caaaaa"] == (None, "caaaaa", 25, 1, None)
    assert rows["lonely"] == (None, "lonely", 9, 0, None)


def test_vocabulary_of_awkward_documents(spark):
    docs = [(1, None), (None, "Straße ÉTÉxyz"), (2, ""), (3, "AbCdEf-abcdef ×ab÷cdé short"), (3, "AbCdEf-abcdef ×ab÷cdé short"), (4, "w" * 100_000), (5, "abcdef\U0001d4b3abcdef ĀbcdefĀ")]
    docs += [(100 + i, "gargantuan") for i in range(600)]
    df = spark.createDataFrame([(*d, "x", "y") for d in docs], "doc_id long, text string, id string, run string")
    found = spelling_variants.vocabulary(spelling_variants.slipped(spelling_variants.runs(df)), least=1)
    want = defaultdict(int)
    for doc, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            at = h % len(run)
            word = run[:at] + run[at + 1:] if h % 199 == 0 else run
            if len(word) >= 6:
                want[word] += 1
    assert {r["word"]: r["n"] for r in found.collect()} == want
    assert len([w for w in want if w.startswith("garg") or len(w) == 9]) > 1       # some runs did slip


def test_variants_without_words(spark):
    assert variants_of(spark, {}) == []


@needs_tables
def test_variants_sql(spark):
    same_as_sql(spark, "op12_spelling_variants", ["documents"])


# ------------------------------------------------------------------ 13

PAPER = "doc_id long, text string, n long, d1 long, root string, nid string, key string, raw string"


def brute_jaccard(docs, size=3, share=(9, 10)):
    def grams(text):
        words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = WORD.findall(words)
        return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()

    sets = [grams(t) for _, t in docs]
    root = list(range(len(docs)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and share[1] * len(a & b) >= share[0] * len(a | b):
                root[max(top(i), top(j))] = min(top(i), top(j))
    groups = defaultdict(list)
    for i in range(len(docs)):
        groups[top(i)].append(docs[i][0])
    out = []
    for i, (doc, _) in enumerate(docs):
        ids = [d for d in groups[top(i)] if d is not None]
        out.append((doc, len(sets[i]), doc if not sets[i] else min(ids, default=None)))
    return sorted(out, key=repr)


def joined(spark, docs, **kw):
    df = spark.createDataFrame([(*d, 1, 2, "x", "y", "z", "w") for d in docs], PAPER)
    return sorted(map(tuple, jaccard_join.jaccard_components(df, **kw).collect()), key=repr)


def papers(seed, families=6, copies=14, words=(4, 90)):
    """Families of copies with a few words replaced, around the threshold."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    footer = " ".join(rng.choice(vocabulary) for _ in range(25))
    docs = []
    for f in range(families):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(*words))]
        for c in range(copies):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            if rng.random() < 0.3:
                text = text[:rng.randint(max(1, len(text) - 8), len(text))]
            docs.append((1000 * f + c, " ".join(text) + (" " + footer if f % 2 else "")))
    docs += [(9000 + i, f"only{i} " + footer) for i in range(10)]
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_equals_brute_force(spark, seed):
    docs = papers(seed) + [(1, None), (2, ""), (None, "null id of three"), (None, "null id of three"), (None, None), (3, "Two Words"), (4, "two\twords"), (5, "é é é"), (6, "É É É"),
                           (7, "a b c"), (7, "a b c"), (8, "long " * 30_000), (8, "a " * 20_000 + "b"), (9, " \n ")]
    assert joined(spark, docs) == brute_jaccard(docs)


def test_jaccard_small_tiles_and_poor_order(spark):
    """Groups far beyond a tile, a sketch without use, no families found first."""
    docs = papers(3, families=4, copies=40, words=(30, 60))
    want = brute_jaccard(docs)
    assert joined(spark, docs, tile=4, sketch=1 << 16) == want


def test_jaccard_does_not_rely_on_the_first_round(spark, monkeypatch):
    docs = papers(4, families=3, copies=25, words=(30, 60))
    monkeypatch.setattr(jaccard_join, "chains", lambda shared, share: shared.where("1 = 0").selectExpr("nid as a", "nid as b"))
    assert joined(spark, docs, tile=8) == brute_jaccard(docs)


def test_jaccard_partners_equal_brute_force():
    """Whole tokens over any cut into batches, repeated rows, each row's own reach."""
    rng = np.random.default_rng(7)
    for _ in range(100):
        rows = sorted((int(t), int(n), int(d), int(n - 3 + (t + 3 * d + 7 * n) % 5)) for t, n, d in rng.integers(1, [6, 30, 20], (int(rng.integers(1, 60)), 3)))
        once = sorted(set(rows))
        want = [a[:3] for a in once if any(a != b and a[0] == b[0] and a[1] <= b[3] and b[1] <= a[3] for b in once)]
        edges = [0, *sorted(rng.integers(0, len(rows) + 1, 4).tolist()), len(rows)]
        batches = [pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows[i:j]], pa.int64()) for k in range(4)], ["token", "n", "d1", "reach"]) for i, j in itertools.pairwise(edges)]
        assert [tuple(r.values()) for b in jaccard_join._partners(batches) for r in b.to_pylist()] == want


def test_jaccard_keeps_only_ngrams_at_which_sets_can_link(spark, monkeypatch):
    """Prefix n-grams in common with sets out of reach are not stored, nor are all prefix n-grams."""
    kept, plain = {}, jaccard_join.store

    def noted(df, name, *args):
        out = plain(df, name, *args)
        if "token" in out.columns:
            kept[name] = kept.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard_join, "store", noted)
    docs = [(k, " ".join(f"w{i}" for i in range(int(20 * 1.3 ** k)))) for k in range(8)]         # one inside the next, sizes too far apart
    assert joined(spark, docs) == brute_jaccard(docs)
    assert sum(kept.values()) == 0
    docs += [(10 + k, t + " end") for k, t in docs]
    assert joined(spark, docs) == brute_jaccard(docs)
    assert sum(kept.values()) > 0


def test_jaccard_rows_repeated_many_times(spark):
    """Copies of a row send their segments once and do not multiply overlaps."""
    docs = [(i, t) for i, t in papers(5, families=2, copies=6, words=(30, 60)) for _ in range(7)]
    assert joined(spark, docs) == brute_jaccard(docs)


def test_sketch_is_gathered_by_few_jobs(spark):
    """Not one job for each shuffle partition."""
    held = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    sc = spark.sparkContext
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        sc.setJobGroup("sketch", "sketch")
        found = count_min.counters(spark.range(1000).select("id"), 1 << 16, 1, lambda c: c.astype(np.uint8))
        assert len(sc.statusTracker().getJobIdsForGroup("sketch")) < 10
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
        for k in ("spark.jobGroup.id", "spark.job.description"):
            sc.setLocalProperty(k, None)
    assert found.tolist() == np.bincount(count_min.cells(np.arange(1000), 1 << 16, 0), minlength=1 << 16).tolist()


def test_jaccard_without_rows(spark):
    assert joined(spark, []) == []


@needs_tables
def test_jaccard_over_documents(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, queries.op13_jaccard_join(spark, SF).select("doc_id", "n_shingles", "component_id").collect()), key=repr) == brute_jaccard(docs)
