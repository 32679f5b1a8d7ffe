"""Each operator against a brute-force version, its SQL or a round trip, and on awkward rows."""

import hashlib
import itertools
import os
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from labelqa.llm import (chat_format, decontaminate, mixing, quality_classifier, quality_rules, queries, secret_scan,
                         simhash_dedup, suffix_dedup, token_output, warc)
from labelqa.llm.common import shared_path, text_of

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
DOC = "doc_id long, text string, lang string, source string, n_chars long, kept string, fp string, component_id string, topic string"


def frame(spark, rows):
    """Documents with columns whose names the operators use themselves."""
    return spark.createDataFrame([(*r, "x", "y", "z", "w")[:9] if len(r) == 5 else (r[0], r[1], "en", "s", 1, "x", "y", "z", "w") for r in rows], DOC)


AWKWARD = [(1, None), (2, ""), (None, "null id"), (None, None), (3, "same row"), (3, "same row"), (4, "word " * 30_000), (5, "é\x85\xa0  \x00 𝒳"), (6, "\n\n \t"), (7, "a\\</s>")]


@pytest.fixture(scope="module")
def awkward(spark):
    return frame(spark, AWKWARD).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


# ------------------------------------------------------------------ 1

def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    often = defaultdict(list)
    for i in range(len(words) - 2):
        often[tuple(words[i:i + 3])].append(i)
    inside = {i + k for at in often.values() if len(at) > 1 for i in at for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def test_quality_counts_and_order_free_verdict(spark, awkward):
    rng = random.Random(1)
    rows = AWKWARD + [(100 + i, " ".join(rng.choice("abcd") * rng.randint(1, 2) for _ in range(rng.randint(0, 200)))) for i in range(60)]
    df = frame(spark, rows)
    for order in (quality_rules.RULES, tuple(reversed(quality_rules.RULES)), quality_rules.plan(df, quality_rules.RULES, sample_rows=20)):
        got = df.select("doc_id", "text", quality_rules.report(text_of(), order).alias("r")).collect()
        assert sorted(((r.doc_id, r.text, *(r.r[f] for f in quality_rules.FIELDS)) for r in got), key=repr) == sorted(((d, t, *brute_quality(t)) for d, t in rows), key=repr)
        kept = {r.text for r in got if r.r.kept}
        assert kept == {t for _, t in rows if brute_quality(t)[0] >= 50 and quality_rules.first_failure(quality_rules.Facts(t or ""), quality_rules.BASE + quality_rules.RULES) is None}


def test_quality_cascade_stops_at_the_first_failure():
    facts = quality_rules.Facts("### ### ###")
    assert quality_rules.first_failure(facts, [quality_rules.RULES[0], quality_rules.BASE[1]]) == "symbols"
    assert "ids" not in facts.__dict__          # the costly rule never ran


def test_quality_empty_and_columns(empty, awkward):
    assert quality_rules.kept_documents(empty).count() == 0
    assert quality_rules.kept_documents(awkward).columns == awkward.columns


# ------------------------------------------------------------------ 2

def brute_repeats(rows):
    seen, cover = defaultdict(list), [np.zeros(len((t or "").encode()), bool) for _, t in rows]
    for i, (_, t) in enumerate(rows):
        b = (t or "").encode()
        for s in range(len(b) - 199):
            seen[b[s:s + 200]].append((i, s))
    for at in seen.values():
        if len(at) > 1:
            for i, s in at:
                cover[i][s:s + 200] = True
    out = []
    for (d, t), c in zip(rows, cover, strict=True):
        raw = np.frombuffer((t or "").encode(), np.uint8)
        out.append((d, len(raw), int(c.sum()), int(np.count_nonzero(np.diff(c.astype(int), prepend=0) == 1)), hashlib.sha256(raw[~c].tobytes()).hexdigest()))
    return sorted(out, key=repr)


def repeated_corpus():
    rng = random.Random(3)
    words = ["the", "of", "né", "übr"] + ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(200)]
    many = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared, rows = [many(60) for _ in range(4)], []
    for i in range(160):
        r = rng.random()
        if r < .2 and rows:
            t = rng.choice(rows)[1]
        elif r < .5 and rows:
            w = rng.choice(rows)[1].split(" ")
            for _ in range(max(1, len(w) // 60)):
                w[rng.randrange(len(w))] = rng.choice(words)
            t = " ".join(w)
        elif r < .75:
            t = f"{many(rng.randint(1, 60))} {rng.choice(shared)} {many(rng.randint(1, 60))}"
        else:
            t = many(rng.randint(1, 200))
        rows.append((i, t))
    return rows + [(900, None), (901, ""), (902, "x" * 199), (903, "y" * 200), (904, "z" * 201), (905, "abcd" * 900)]


@pytest.mark.parametrize("group", [4096, 2])
def test_suffix_dedup_is_exact(spark, group):
    rows = repeated_corpus()
    got = suffix_dedup.without_repeats(frame(spark, rows).repartition(3), group)
    assert sorted(map(tuple, got.collect()), key=repr) == brute_repeats(rows)


def test_suffix_dedup_repeated_and_null_ids(spark, empty):
    rows = repeated_corpus()[:40]
    rows = rows + rows[:5] + [(None, rows[3][1]), (None, rows[4][1]), (5, "other " + rows[9][1])]
    assert sorted(map(tuple, suffix_dedup.without_repeats(frame(spark, rows)).collect()), key=repr) == brute_repeats(rows)
    assert suffix_dedup.without_repeats(empty).count() == 0


def test_interval_tree_gives_all_occurrences_of_maximal_repeats():
    members = [(b"aaXsharedZ", 3), (b"aaXsharedY", 3), (b"bbXsharedY", 3), (b"qsharedW", 1)]
    found = sorted(sorted((m, a, b) for m, a, b in g) for g in suffix_dedup.maximal_repeats(members, 7))
    assert found == [[(0, 0, 9), (1, 0, 9), (2, 2, 9)], [(1, 2, 10), (2, 2, 10)]]


# ------------------------------------------------------------------ 3

def brute_secrets(text):
    text = text or ""
    letters = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    words = "|".join(map(letters, ("password", "passwd", "secret", "token"))) + "|" + letters("api") + "_?" + letters("key")
    out = [(m.start(), 0, m.end()) for m in re.finditer(rf"""({words})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_secrets_base_and_random(spark, empty):
    rng = random.Random(5)
    parts = ["password = 'abcd1234'", "token: api_key = abcdefgh12", "PassWD=short", "AKIA" + "Z" * 12, "AKIA" + "Z" * 11, "AKIAAKIA" + "0" * 8, "0" * 31, "deadbeef" * 4, "0123456789abcdef" * 3, "é𝒳", "secret:\"x=y==zzz9\"", "word", "\n"]
    key = "".join(rng.choice(secret_scan.UPPER + secret_scan.LOWER + secret_scan.DIGITS) for _ in range(48))
    plain = "thereforeunquestionablyinternationally"
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))) for i in range(80)] + AWKWARD + [(500, f"see {key} and {plain} here"), (501, plain)]
    got = secret_scan.scan(frame(spark, rows)).collect()
    base = sorted(((r.doc_id, [(s.start, s.kind_no, s.end) for s in r.fixed]) for r in got), key=repr)
    assert base == sorted(((d, brute_secrets(t)) for d, t in rows), key=repr)
    added = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind_no == 3] for r in got}
    assert added[500] == [(4, 52)] and added[501] == []
    for r in got:
        assert set(map(tuple, r.fixed)) <= set(map(tuple, r.spans))
    assert secret_scan.scan(empty).count() == 0


@pytest.mark.parametrize("encoding, size, least", [("hex", 24, .8), ("hex", 31, .8), ("HEX", 24, .8), ("HEX", 40, .9), ("HEX", 64, .9), ("base32", 24, .8), ("base32", 40, .9),
                                                   ("alnum", 24, .8), ("base64", 40, .9), ("base64url", 40, .9)])
def test_planted_keys_by_encoding_and_length(spark, encoding, size, least):
    rng = random.Random(f"{encoding}{size}")
    letters = next(a for n, _, a in secret_scan.ENCODINGS if n == encoding)
    ordinary = ["therefore" * 3, "INTERNATIONALIZATIONS", "getHttpResponseCodeForUser", "deadbeef" * 3, "0123456789" * 3, "20240115093000000012", "chpfheitschverheiten", "IMG20240115093000000", "0" * 25, "-" * 40]
    rows = [(i, f"see {''.join(rng.choice(letters) for _ in range(size))} here") for i in range(40)] + [(100 + i, f"see {w} here") for i, w in enumerate(ordinary)]
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind_no == 3] for r in secret_scan.scan(frame(spark, rows)).collect()}
    assert sum(got[i] == [(4, 4 + size)] for i in range(40)) >= 40 * least
    assert not any(got[100 + i] for i in range(len(ordinary)))


def test_keys_glued_to_other_text(spark):
    rng = random.Random(11)
    keys = ["".join(rng.choice(secret_scan.UPPER + secret_scan.LOWER + secret_scan.DIGITS) for _ in range(40)) for _ in range(4)]
    texts = [f"AWS_KEY={keys[0]}", f"{keys[1]}={keys[2]}", f"a/b_c+{keys[3]}", f"sig={keys[0]}=="]
    got = {r.doc_id: [(s.start, s.end) for s in r.spans if s.kind_no == 3] for r in secret_scan.scan(frame(spark, list(enumerate(texts)))).collect()}
    assert got[0] == [(8, 48)] and got[1] == [(0, 40), (41, 81)] and got[3] == [(4, 46)]
    assert any(a <= 6 and b == 46 for a, b in got[2])


# ------------------------------------------------------------------ 4

def brute_simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius):
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return [root(i) for i in range(len(fps))]


def test_simhash_fingerprints_equal_sparks_hash(spark):
    t = "One two  THREE"
    assert simhash_dedup.simhash(t.encode(), 3) == spark.sql("select xxhash64('one two three')").first()[0]
    for _, t in AWKWARD:
        assert simhash_dedup.simhash((t or "").encode(), 3) & (2**64 - 1) == brute_simhash(t)


@pytest.mark.parametrize("radius, tile", [(2, 4096), (2, 4), (3, 4096), (0, 4096)])
def test_simhash_links_are_exact(spark, radius, tile):
    rng = np.random.default_rng(radius)
    fps = set()
    for start in rng.integers(0, 2**64, 40, dtype=np.uint64).tolist():
        x = start
        for _ in range(int(rng.integers(1, 40))):
            fps.add(x)
            x = start if rng.random() < .3 else x
            for b in rng.integers(0, 64, int(rng.integers(0, 4))).tolist():
                x ^= 1 << b
    fps = sorted(fps)
    want = brute_components(fps, radius)
    nodes = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "fp long")
    found = {r.node & (2**64 - 1): r.root for r in simhash_dedup.components(simhash_dedup.links(nodes, radius, tile)).collect()}
    got = defaultdict(set)
    for f in fps:
        got[found.get(f, f"alone {f}")].add(f)
    groups = defaultdict(set)
    for f, r in zip(fps, want, strict=True):
        groups[r].add(f)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_simhash_documents(spark, awkward, empty):
    got = sorted(((r.id, r.fp, r.component_id) for r in simhash_dedup.near_duplicates(awkward).collect()), key=repr)
    fps = [brute_simhash(t) for _, t in AWKWARD]
    roots = brute_components(fps, 2)
    least = {r: min((d for (d, _), x in zip(AWKWARD, roots, strict=True) if x == r and d is not None), default=None) for r in roots}
    assert got == sorted(((d, f - 2**64 if f >= 2**63 else f, least[r]) for (d, _), f, r in zip(AWKWARD, fps, roots, strict=True)), key=repr)
    kept = simhash_dedup.one_of_each(awkward)
    assert kept.columns == awkward.columns and kept.count() == len(set(roots))
    assert simhash_dedup.near_duplicates(empty).count() == 0 and simhash_dedup.one_of_each(empty).count() == 0


# ------------------------------------------------------------------ 5

@pytest.mark.parametrize("archive_bytes", [1 << 25, 700])
def test_warc_round_trip(spark, archive_bytes):
    big = "é<p>\r\n\r\nWARC/1.1\r\n" * 100
    rows = [(1, "http://a/\r\nx", big), (2, "http://b", big), (3, None, big), (4, "u", "short"), (5, "u", "short"), (6, "u", None), (7, "u", ""), (None, "u", big), (None, None, None),
            (3, None, big), (8, "q", "z" * 1000), (9, "q", "z" * 1000), (10, "q", "z" * 999), (11, "q", "z" * 999)]
    pages = spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, digest string")
    path = shared_path(spark, "warc")
    index = warc.write_archives(pages, path, archive_bytes)
    got = sorted(((r.page_id, r.url, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, bytes(r.payload)) for r in warc.read_records(index, path, gap=0, most=500).collect()), key=repr)
    want = []
    for page, url, html in rows:
        raw = (html or "").encode()
        last = max((p for p, _, h in rows if h == html and p is not None), default=None) if len(raw) >= 1000 else None
        old = page is not None and last is not None and page < last
        want.append((page, url and url.replace("\r\n", ""), len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if old else "response", last if old else None, b"" if old else raw))
    assert got == sorted(want, key=repr)
    some = warc.read_records(index.where("page_id in (4, 9)"), path)
    assert sorted(r.page_id for r in some.collect()) == [4, 9]
    assert warc.round_trip(pages.limit(0)).count() == 0


# ------------------------------------------------------------------ 6

@pytest.mark.parametrize("size", [1, 2, 3, 100, 1000, 4097])
def test_feistel_permutes(size):
    out = token_output.Feistel(size, 99)(np.arange(size))
    assert sorted(out.tolist()) == list(range(size))
    assert size < 100 or out.tolist() != list(range(size))


def test_token_shards_round_trip(spark, awkward, empty):
    path = shared_path(spark, "tokens")
    token_output.write_shards(awkward, path, seq_len=16, shard_text_bytes=20_000)
    rows = token_output.read_sequences(spark, path, seq_len=16, chunk_bytes=200).collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    with open(token_output.VOCABULARY, "rb") as f:
        encode, end = token_output.encoder(f.read())
    got = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, tuple(np.frombuffer(r.tokens, "<u2").tolist())))
    want = defaultdict(list)
    for d, t in AWKWARD:
        ids = [*encode.encode_ordinary(t or ""), end]
        want[d] += [(k, tuple(ids[k * 16:k * 16 + 16])) for k in range(-(-len(ids) // 16))]
    assert {d: sorted(x) for d, x in got.items()} == {d: sorted(x) for d, x in want.items()}
    later = token_output.read_sequences(spark, path, seq_len=16, first=len(rows) - 5).collect()
    assert sorted(map(tuple, later)) == sorted(map(tuple, rows), key=lambda r: r[0])[-5:]
    assert token_output.training_order(empty).count() == 0


def test_token_order_does_not_depend_on_partitions(spark, awkward):
    a = token_output.training_order(awkward.repartition(1), seq_len=16).orderBy("slot").collect()
    assert a == token_output.training_order(awkward.repartition(5), seq_len=16).orderBy("slot").collect()


def test_sparse_document_ids(spark):
    df = frame(spark, [(-2**62, "a b c"), (2**62, "d e f"), (0, "g")])
    assert {r.doc_id for r in token_output.training_order(df, seq_len=4).collect()} == {-2**62, 2**62, 0}


@pytest.mark.parametrize("run", [" ", "\n", " \n", "\u3000 \t"])
def test_long_white_space_has_the_ids_of_the_pattern(run):
    encode, _ = token_output.encoder(open(token_output.VOCABULARY, "rb").read())
    for text in (run * 3000, "x" + run * 3000 + "y", "x " + run * 3000 + "'s 1" + run * 3000 + "\n", run * 3000 + ".", "a b" + run * 2 + "c"):
        assert token_output.token_ids(encode, text, long_run=5) == encode.encode_ordinary(text)


def test_texts_of_millions_of_one_character(spark):
    texts = ["x" + " " * 5_000_000 + "y", "\n" * 5_000_000, "a" * 5_000_000, "!" * 5_000_000]
    encode, end = token_output.encoder(open(token_output.VOCABULARY, "rb").read())
    path = shared_path(spark, "long")
    token_output.write_shards(frame(spark, list(enumerate(texts))), path)
    got = token_output.read_sequences(spark, path)
    n = {r.doc_id: r.n for r in got.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()}
    assert n == {i: len(token_output.token_ids(encode, t)) + 1 for i, t in enumerate(texts)}
    parts = got.where("doc_id = 0").orderBy("piece").select("tokens").collect()
    ids = np.frombuffer(b"".join(r.tokens for r in parts), "<u2").tolist()
    assert encode.decode(ids[:-1]) == texts[0]


# ------------------------------------------------------------------ 7

def brute_raking(cells, goal, budget):
    """Capped raking by bisection: chance min(1, product of factors), every reachable marginal met."""
    words = cells
    wanted = budget * sum(words.values())

    def factor(parts, aim):
        if sum(n for n, r in parts if r > 0) <= aim:
            return max(1 / r for _, r in parts if r > 0)
        low, high = 0.0, max(1 / r for _, r in parts if r > 0)
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(n * min(1, mid * r) for n, r in parts) < aim else (low, mid)
        return high

    aims = []
    for k, dim in enumerate(("source", "lang", "topic")):
        held = defaultdict(int)
        for c, n in words.items():
            held[c[k]] += n
        f = factor([(n, goal[dim][v] / n) for v, n in held.items()], wanted)
        aims.append({v: n * min(1, f * goal[dim][v] / n) for v, n in held.items()})
    ratio = dict.fromkeys(words, 1.0)
    for _ in range(400):
        for k, aim in enumerate(aims):
            for v, want in aim.items():
                inside = [c for c in words if c[k] == v]
                f = factor([(words[c], ratio[c]) for c in inside], want)
                ratio |= {c: min(1e100, ratio[c] * f) for c in inside}
    return {c: min(1.0, r) for c, r in ratio.items()}, aims


def test_raking_equals_brute_force(spark):
    """Null values, cells taken whole whose share goes to others."""
    rng = random.Random(7)
    words = {(s, g, t): rng.randint(300, 900) for s in ("a", "b", None) for g in ("en", "fr", None) for t in ("x", "y", "z")}
    goal = {"source": {"a": .45, "b": .3, None: .25}, "lang": {"en": .45, "fr": .3, None: .25}, "topic": {"x": .3, "y": .3, "z": .4}}
    cells = spark.createDataFrame([(*c, n) for c, n in words.items()], "source string, lang string, topic string, words long")
    targets = {d: spark.createDataFrame(list(v.items()), f"{d} string, share double") for d, v in goal.items()}
    got = {tuple(r)[:3]: r.p for r in mixing.capped_probabilities(cells, 0.6, targets=targets, tolerance=1e-7).collect()}
    want, aims = brute_raking(words, goal, 0.6)
    assert any(p == 1 for p in want.values()) and any(p < 1 for p in want.values())
    for k, aim in enumerate(aims):
        for value, n in aim.items():
            assert sum(words[c] * got[c] for c in words if c[k] == value) == pytest.approx(n, rel=1e-4)
    assert got == pytest.approx(want, abs=1e-4)
    assert sum(words[c] * got[c] for c in words) == pytest.approx(0.6 * sum(words.values()), rel=1e-5)


def test_raking_says_when_it_does_not_settle(spark):
    cells = spark.createDataFrame([("a", "en", "x", 100), ("b", "fr", "x", 100), ("b", "en", "x", 1)], "source string, lang string, topic string, words long")
    share = lambda d, **v: spark.createDataFrame(list(v.items()), f"{d} string, share double")
    with pytest.warns(UserWarning, match="raking stopped"):
        mixing.capped(cells, 0.5, {"source": share("source", a=.9, b=.1), "lang": share("lang", en=.1, fr=.9), "topic": share("topic", x=1.0)}, rounds=2)


def test_mixture_of_documents_meets_its_marginals(spark):
    """The query: expected words by value are those that can be had, the budget is spent."""
    got = queries.op7_mixing(spark, SF).collect()
    whole = sum(r.n_words for r in got)
    assert sum(r.n_words * r.p for r in got) == pytest.approx(mixing.BUDGET * whole, rel=1e-5)
    rows = spark.createDataFrame(got).selectExpr("source", "lang", "topic", "n_words")
    for r in mixing.reached_shares(mixing.cells_of(rows)).collect():
        assert sum(x.n_words * x.p for x in got if str(x[r.dim]) == r.value) == pytest.approx(r.reachable * mixing.BUDGET * whole, abs=1e-4 * whole)


def test_mixture_on_awkward_rows(spark, awkward, empty):
    got = mixing.mixture(awkward, rounds=2)
    assert got.count() == len(AWKWARD) and mixing.mixture(empty, rounds=1).count() == 0
    kept = mixing.sampled_documents(awkward, budget=1000.0, rounds=2)
    assert kept.columns == awkward.columns
    # two cells: one of chance 1 at this budget, one (a lone tab) without words
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted((tuple(r) for r in awkward.collect() if r.doc_id != 6), key=repr)
    assert mixing.sampled_documents(empty, rounds=1).count() == 0


def test_cut_mass_goes_to_the_other_cells(spark):
    cells = spark.createDataFrame([("a", "en", "x", 10), ("a", "fr", "x", 100), (None, "en", "x", 500), (None, "fr", "x", 390)], "source string, lang string, topic string, words long")

    def targets(**goal):
        return {d: spark.createDataFrame(list(v.items()), f"{d} string, share double") for d, v in goal.items()}

    goal = {"source": {"a": .16, None: .84}, "lang": {"en": .6, "fr": .4}, "topic": {"x": 1.0}}
    p = {tuple(r)[:2]: r.p for r in mixing.capped_probabilities(cells, 0.5, targets=targets(**goal), rounds=12, tolerance=1e-5).collect()}
    # the first cell has 10 words and would be asked for more; the rest follows from the targets
    assert p == pytest.approx({("a", "en"): 1.0, ("a", "fr"): .7, (None, "en"): .58, (None, "fr"): 130 / 390}, abs=1e-3)
    # half of the budget is more than a source has: it is taken whole and the other fills the budget
    goal["source"] = {"a": .5, None: .5}
    got = {(r.dim, r.value): r for r in mixing.reached_shares(cells, 0.5, targets=targets(**goal), rounds=12, tolerance=1e-5).collect()}
    assert got["source", "a"].target == .5
    assert {v: got["source", v].reached for v in ("a", None)} == pytest.approx({"a": .22, None: .78}, abs=1e-3)


# ------------------------------------------------------------------ 8

def rendered(template, **names):
    return "".join(t for t, _ in chat_format.compiled(template)(names))


def test_templates_are_compiled():
    assert rendered("{% for m in ms %}{{ loop.index0 }}{{ m['r'] | upper }}{% if loop.last %}.{% elif loop.first %}^{% else %},{% endif %}{% endfor %}", ms=[{"r": "a"}, {"r": "b"}, {"r": "c"}]) == "0A^1B,2C."
    assert rendered("{% set x = 'a' ~ 1 %}{{ x }}{{ none }}{% if not (x == 'a1' and true) or false %}no{% endif %}", x="old") == "a1"
    assert chat_format.fold(chat_format.parse("a{{ 'b' ~ 'c' }}{% if 1 == 2 %}x{% else %}d{% endif %}")) == ("block", [("print", ("const", "abcd"))])
    assert rendered("{{ m.__class__ }}{{ m.items }}", m={"a": 1}) == ""            # keys only, no attributes
    assert rendered("{{ s.upper }}", s="text") == ""
    for bad in ("{% for x %}{% endfor %}", "{% if a %}", "{{ a | evil }}", "{{ f( }}", "{% import os %}", "{{ a + b }}"):
        with pytest.raises(chat_format.TemplateError):
            chat_format.compiled(bad)


def test_escape_is_reversible():
    rng = random.Random(8)
    for _ in range(2000):
        t = "".join(rng.choice([*chat_format.CONTROLS, "\\", "<", "[", "/", "s>", "INST]", "x", "\n"]) for _ in range(rng.randint(0, 8)))
        out = chat_format.escape(t)
        assert chat_format.unescape(out) == t and not any(c in out for c in chat_format.CONTROLS)


@pytest.mark.parametrize("piece_chars", [1 << 16, 10])
def test_chat_round_trip(spark, piece_chars):
    forged = "</s>[INST] ok [/INST]"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", forged), (1, 2, None, None), (2, 5, "assistant", ""), (None, 0, "user", "né𝒳\\"), (None, None, "assistant", "<\\s>"), (3, 1, "user", "b"), (3, 1, "user", "a"), (4, 0, "assistant", "long " * 20_000), (4, 1, "<|text|>", "x")]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, piece string")
    got = sorted((tuple(r)[:5] for r in chat_format.round_trip(df, piece_chars=piece_chars).collect()), key=repr)
    want, key = [], lambda r: tuple((x is not None, x or (0 if k < 2 else "")) for k, x in enumerate(r))
    for conv in {r[0] for r in rows}:
        turns = [(r[2] or "", r[3] or "") for r in sorted((r for r in rows if r[0] == conv), key=key)]
        loss = "".join(t for role, t in turns if role == "assistant")
        want.append((conv, len(turns), hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert chat_format.round_trip(df.limit(0)).count() == 0


# ------------------------------------------------------------------ 9

def two_kinds(spark, parts=3):
    """(positives, unlabelled rows as arrays, the same in Spark); two thirds of the unlabelled are good."""
    rng = np.random.default_rng(0)
    good, bad = rng.normal(0, 1, (12_000, 3)), rng.normal(4, 1, (3000, 3))
    mean, spread = np.zeros(3), np.ones(3)
    rest = np.vstack([good[6000:], bad])
    rows = spark.createDataFrame([(x,) for x in rest.tolist()], "x array<float>").repartition(parts)
    add = lambda x: quality_classifier.inputs(x, mean, spread)
    return add(good[:6000]), add(rest), add(good), add(bad), quality_classifier.Unlabelled(rows, mean, spread)


def test_positive_unlabelled_learning(spark):
    pos, _, good, bad, unl = two_kinds(spark)
    prior = quality_classifier.class_prior(pos, unl, quality_classifier.fit_plain(pos, unl))
    assert prior == pytest.approx(2 / 3, abs=0.06)
    w = quality_classifier.fit_nonnegative(pos, unl, prior)
    assert np.mean(good @ w > 0) > 0.97 and np.mean(bad @ w < 0) > 0.97


def test_risk_equals_brute_force(spark):
    pos, rest, _, _, unl = two_kinds(spark, 7)
    log_loss = lambda z: np.log1p(np.exp(z))
    second = lambda w, prior: log_loss(rest @ w).mean() - prior * log_loss(pos @ w).mean()
    full = lambda w, prior: prior * log_loss(-(pos @ w)).mean() + second(w, prior)
    for prior in (0.3, 0.67, 0.95):
        risk = quality_classifier.nonnegative_risk(pos, unl, prior)
        for w in (np.zeros(4), np.array([0.5, -1, 0.2, 0.1])):
            value, part, gradient, curve = risk(w)
            assert value == pytest.approx(full(w, prior), abs=1e-5) and part == pytest.approx(second(w, prior), abs=1e-5)
            for k, e in enumerate(np.eye(4) * 1e-4):
                assert gradient[k] == pytest.approx((full(w + e, prior) - full(w - e, prior)) / 2e-4, abs=1e-4)
                assert curve[k] == pytest.approx((risk(w + e)[2] - risk(w - e)[2]) / 2e-4, abs=1e-4)
        w = quality_classifier.fit_nonnegative(pos, unl, prior)
        assert second(w, prior) >= -1e-6 and full(w, prior) < full(np.zeros(4), prior)
        if second(w, prior) > 1e-3:      # not stopped at the edge: the least risk
            assert np.abs(risk(w)[2] + 1e-4 * w).max() < 1e-3
    cuts = np.linspace(-6, 6, 20)
    w = np.array([0.5, -1, 0.2, 0.1])
    scores = rest @ w
    assert unl.above(w, cuts) == pytest.approx([(scores >= c).mean() for c in cuts], abs=1e-3)


def test_classifier_where_every_row_is_labelled_and_samples_are_cut(spark):
    rng = random.Random(2)
    texts = [(k, " ".join(rng.choice(["plain", "words", "of", "prose", "here"]) for _ in range(60)) if k % 3 else "#$% || !!! " * 20 + str(k)) for k in range(300)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k, _ in texts], "doc_id long, quality int")
    for sample in (20_000, 30):
        got = quality_classifier.classified(docs, labels, sample=sample).collect()
        good, bad = ([r.score for r in got if (r.doc_id % 3 > 0) == kind] for kind in (True, False))
        assert len(got) == 300 and min(good) > max(bad)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="driver tables not present")
def test_classifier_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    got = entry.queries()["op9_quality_classifier"](spark, sf).where("held_out")
    r = got.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").agg(
        F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("right"),
        F.avg(F.when(F.col("quality") == 1, F.col("predicted"))).alias("kept")).first()
    assert r.right > 0.97 and r.kept > 0.98


def test_classifier_on_awkward_rows(spark, awkward, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 0), (3, 1, 0), (4, 0, 0), (None, 1, 0), (5, None, 0), (3, 1, 0)], "doc_id long, quality int, toxic int")
    for labels in (none, some):
        rows = quality_classifier.classified(awkward, labels).collect()
        assert len(rows) == len(AWKWARD) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    assert quality_classifier.classified(empty, some).count() == 0


# ------------------------------------------------------------------ 10

def test_leaks_with_substitutions(spark, awkward, empty):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    items = [[word() for _ in range(n)] for n in (40, 25, 13, 6)]
    bench = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(8, None), (9, ""), (None, "...")], "item_id long, text string")
    rows, want = list(AWKWARD), {}
    for i in range(120):
        k, text, wrong = i % 4, [], 0
        part = list(items[k])
        if i % 3 == 0 and k < 2:
            for at in rng.sample(range(2, len(part) - 2), len(part) // 8):
                part[at], wrong = word(), wrong + 1
        before = [word() for _ in range(rng.randint(0, 30))]
        if i % 5 == 0:
            part = part[:len(part) // 4]            # too little of the item
        text = before + part + [word() for _ in range(rng.randint(0, 30))]
        if i % 5:
            want[1000 + i] = (k, len(before), len(part), len(part) - wrong)
        rows.append((1000 + i, ", ".join(text).upper()))
    got = decontaminate.leaks(frame(spark, rows), bench).collect()
    assert {r.doc_id: (r.item_id, r.start_word, r.n_words, r.n_equal) for r in got} == want and len(got) == len(want)
    split = decontaminate.leaks(frame(spark, rows), bench, block_words=40)
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, got))
    clean = decontaminate.clean_documents(frame(spark, rows), bench)
    assert clean.count() == len(rows) - len(want) and clean.columns == awkward.columns
    assert decontaminate.leaks(empty, bench).count() == 0 and decontaminate.leaks(awkward, bench.limit(0)).count() == 0


def brute_leaks(doc, item, identity=80, min_words=13):
    """Every diagonal, every stretch on it: the longest that begins and ends with an equal word."""
    found = set()
    for shift in range(1 - len(item), len(doc)):
        best = None
        pairs = [(at, doc[at] == item[at - shift]) for at in range(max(0, shift), min(len(doc), shift + len(item)))]
        for b in range(len(pairs)):
            for a in range(b + 1):
                n, same = b - a + 1, sum(x[1] for x in pairs[a:b + 1])
                if pairs[a][1] and pairs[b][1] and 100 * same >= identity * n and n > (best or (0, 0))[1]:
                    best = (pairs[a][0], n, same)
        if best and best[1] >= min(min_words, len(item)):
            found.add(best)
    return found


@pytest.mark.parametrize("identity, min_words", [(80, 13), (70, 8), (100, 6)])
def test_leaks_equal_brute_force(identity, min_words):
    rng = random.Random(identity)
    item = lambda n: [rng.choice("abcdefgh") for _ in range(n)]
    items = [item(n) for n in (1, 2, 3, 4, 5, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15, 17, 20, 26)] + [["a"] * 16]
    seeds = decontaminate.Seeds([(k, " ".join(x)) for k, x in enumerate(items)], identity=identity, min_words=min_words)
    docs = [[], ["a"] * 30, ["zz"] * 30]
    for k in range(60):
        part = list(items[k % len(items)])
        for at in rng.sample(range(len(part)), len(part) // 5):
            part[at] = "zz"
        docs.append(item(rng.randint(0, 12)) + part[rng.randint(0, 2):] + item(rng.randint(0, 12)))
    got = seeds.leaks([" ".join(d) for d in docs])
    for d, hits in zip(docs, got, strict=True):
        assert set(hits) == {(k, *hit) for k, x in enumerate(items) for hit in brute_leaks(d, x, identity, min_words)} and len(hits) == len(set(hits))


@pytest.mark.parametrize("size", range(1, 21))
def test_every_accepted_substitution_is_found(size):
    """All inner places of as many other words as the rule allows."""
    words = [f"w{k}" for k in range(size)]
    seeds = decontaminate.Seeds([(0, " ".join(words))])
    texts = []
    for away in itertools.combinations(range(1, max(1, size - 1)), min(size // 5, max(0, size - 2))):
        texts.append(" ".join("other" if k in away else w for k, w in enumerate(words)))
    assert texts and all(hits for hits in seeds.leaks(texts))


def test_masks_are_proven():
    assert decontaminate.complete(decontaminate.MASKS)
    assert not decontaminate.complete(("1111111",)) and not decontaminate.complete(decontaminate.MASKS[:3])
    for identity, least in ((70, 10), (60, 5), (90, 20), (100, 1)):
        assert decontaminate.complete(decontaminate.masks_for(identity, least), identity, least)


def test_leaks_in_unspaced_script_and_long_texts(spark):
    item = "\u5929\u5730\u7384\u9ec4\u5b87\u5b99\u6d2a\u8352\u65e5\u6708\u76c8\u6603\u8fb0\u5bbf\u5217\u5f20"
    thai = "\u0e01\u0e02\u0e04\u0e07\u0e08"
    bench = spark.createDataFrame([(1, item), (2, "Same same same same"), (3, thai), (4, "the")], "item_id long, text string")
    rows = [(1, "x" * 50 + item[:8] + "\u3002" + item[8:] + "y"), (2, item[:5] + "\u4e00" + item[6:]), (3, item[:12]), (4, "same " * 30_000), (5, "q " * 1_500_000 + item),
            (6, "other, The end"), (7, "then these"), (8, thai), (9, "same, Same; same")]
    got = sorted((r.doc_id, r.item_id, r.n_words, r.n_equal) for r in decontaminate.leaks(frame(spark, rows), bench).where("doc_id <> 4").collect())
    assert got == [(1, 1, 16, 16), (2, 1, 16, 15), (5, 1, 16, 16), (6, 4, 1, 1), (8, 3, 5, 5)]
    assert decontaminate.leaks(frame(spark, rows), bench).where("doc_id = 4").count() == 30_000 - 3


def test_hits_are_taken_in_slices(monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    items = [(k, " ".join(rng.choice("abc") for _ in range(n))) for k, n in enumerate((3, 6, 14, 20))]
    whole = decontaminate.Seeds(items).leaks(texts)
    monkeypatch.setattr(decontaminate, "SLICE", 7)
    monkeypatch.setattr(decontaminate, "PIECE", 5)
    assert decontaminate.Seeds(items).leaks(texts) == whole and any(whole)


# ------------------------------------------------------------------ queries and pipeline

@needs_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    res = con.execute(queries.ORACLE[name])
    cols = [x[0] for x in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(repr, map(tuple, df.select(*cols).collect()))) == sorted(map(repr, res.fetchall()))


@pytest.mark.parametrize("stage", range(5))
def test_pipeline_stages_on_awkward_rows(spark, awkward, empty, stage, tmp_dir):
    spark.createDataFrame([(1, "nothing of it")], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    name, run = corpus_pipeline.STAGES[stage]
    for docs in (awkward, empty):
        out = run(spark, docs, tmp_dir)
        assert out.count() <= docs.count() or stage == 4
        assert stage == 4 or out.columns == docs.columns


@needs_tables
def test_pipeline_over_the_tables(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    left = {r.doc_id for r in out}
    assert left and sorted(r.slot for r in out) == list(range(len(out)))
    for d in left:
        assert quality_rules.first_failure(quality_rules.Facts(docs[d]), quality_rules.BASE + quality_rules.RULES) is None
    fps = [brute_simhash(docs[d]) for d in sorted(left)]
    assert brute_components(fps, 2) == list(range(len(fps)))
