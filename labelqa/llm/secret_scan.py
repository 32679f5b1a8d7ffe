"""Secret scans: fixed patterns, and a randomness battery over long tokens.

DataFrame functions only. The patterns give spans of known kinds. Every other
run of 20 or more token characters is a candidate for the battery: runs end at
an inner ``=``, and one that mixes the signs of base64 (+ /) and of its URL-safe
form (_ -) gives its parts of 20 or more under either alphabet. The encoding is
inferred (decimal, hex, base32, base64, URL-safe base64, alphanumeric), and
tests ask whether the token looks drawn at random from that alphabet:
chi-squared uniformity, Wald-Wolfowitz runs (values below and above the middle
of the alphabet), lag-one serial correlation, and no stretch of 5 to 64
characters that is repeated at once.

The p-value is the chance that an ordinary string of that encoding and length
would look as random. Ordinary strings spell words: their letters have the
frequencies of natural text (over the letters of the encoding, upper and lower
case alike), and words and numbers follow each other without much change
between capitalized words, capitals, digits and signs. Both scores are
joined. Ordinary decimals (dates, counters, padded numbers) have no letters;
their digits agree by ``ORDINARY_DIGITS``, which at 20 to about 27 digits is too
close to chance to tell (32 and more are found by the pattern of ``hex``).
Discoveries are controlled by Benjamini-Hochberg within
each (encoding, length class), over all candidates of the corpus, from counts
in bins of -log10 p: a table of fixed size however large the corpus.

Defined cases: null text is the empty text and has no spans; a null ``doc_id``
is carried; repeated rows are scanned one by one (and counted as often among
the candidates); an empty table gives an empty result; extra columns are not
read. Texts of any length are scanned whole.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store, text_of

#: Fixed patterns of the scan, in the order of their kinds.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"       # the runs of 16 characters or more
HEX = r"[0-9a-f]{32,}"
#: Candidates: runs over base64 and over its URL-safe form, with their padding.
CANDIDATES = tuple(rf"[A-Za-z0-9{signs}]{{20,}}(?:=+(?![A-Za-z0-9+/_=-]))?" for signs in ("+/", "_-"))

#: Encodings: name, pattern, alphabet; the first that fits is taken.
DIGITS, UPPER, LOWER = "0123456789", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ENCODINGS = (("decimal", r"^[0-9]+$", DIGITS), ("hex", r"^[0-9a-f]+$", DIGITS + "abcdef"), ("HEX", r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
             ("base32", r"^[A-Z2-7]+=*$", UPPER + "234567"), ("alnum", r"^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
             ("base64", r"^[A-Za-z0-9+/]+=*$", UPPER + LOWER + DIGITS + "+/"), ("base64url", r"^[A-Za-z0-9_-]+=*$", UPPER + LOWER + DIGITS + "-_"))
#: Letters in per mille of natural text: mean of English, German, French and Spanish.
LETTERS = dict(zip(LOWER, (92, 14, 32, 46, 151, 13, 17, 24, 73, 4, 5, 48, 27, 78, 61, 21, 6, 66, 72, 73, 44, 11, 8, 3, 6, 5), strict=True))
#: Changes between words, numbers and signs per character, and chance that two digits agree, of ordinary strings.
ORDINARY_TURNS, ORDINARY_DIGITS = 0.15, 0.2
#: Letters of a text depend on each other; variances are that much larger than of independent ones.
DISPERSION = 2.0
PIECES, REPEATED = r"[A-Z]*[a-z]+|[A-Z]+|[0-9]+|[^A-Za-z0-9]+", r"(.{5,64})\1"
FALSE_DISCOVERIES, RANDOM_Z, BINS = 0.01, 4.0, 240


def spans(text: Column, pattern: str, group: int = 0, least: int = 1) -> Column:
    """``array<struct<start,end>>`` in code points of the matches whose group
    has ``least`` characters; leftmost, non-overlapping."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    wanted = whole if not group else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    parts = F.arrays_zip(F.slice(F.split(text, pattern, -1), 1, F.size(whole)).alias("gap"), whole.alias("hit"), wanted.alias("want"))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(seen, part):
        start = seen["at"] + F.length(part["gap"])
        end = start + F.length(part["hit"])
        one = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(F.length(part["want"]) >= least, F.concat(seen["out"], one)).otherwise(seen["out"]).alias("out"))

    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), none.alias("out")), step)["out"]
    return F.when(text.rlike(pattern), found).otherwise(none)


def normal_cdf(z: Column) -> Column:
    """Of the standard normal: a rational approximation, and Mills' ratio in the tail."""
    x = F.abs(z)
    t = F.lit(1.0) / (1 + 0.2316419 * x)
    density = F.exp(-x * x / 2) / math.sqrt(2 * math.pi)
    near = density * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.when(x < 3, near).otherwise(density / x * (1 - 1 / (x * x + 2)))
    return F.when(z > 0, 1 - tail).otherwise(tail)


def _let(value: Column, body):
    """Evaluate ``value`` once and hand it to ``body``."""
    return F.transform(F.array(value), body)[0]


def _mean(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v) / F.size(values)


def _spelt(core: Column, letters: str) -> Column:
    """How far the letters lie from those of natural text (standard score, below
    0 for rarer letters); null without letters."""
    all_of = sum(LETTERS[c] for c in letters)
    share = {c: LETTERS[c] / all_of for c in letters}
    score = {c: math.log(max(share[c] * len(letters), 0.1)) for c in letters}
    mean = sum(share[c] * score[c] for c in letters)
    spread = sum(share[c] * (score[c] - mean) ** 2 for c in letters) * DISPERSION

    def of(low):
        held = {c: F.length(low) - F.length(F.replace(low, F.lit(c), F.lit(""))) for c in letters}
        n = sum(held.values(), F.lit(0)).cast("double")
        return (sum((held[c] * score[c] for c in letters), F.lit(0.0)) - n * mean) / F.sqrt(F.nullif(n, F.lit(0.0)) * spread)

    return _let(F.lower(core), of)


def ordinary_z(encoding: Column, core: Column, chi: Column) -> Column:
    """Standard score of a token among ordinary strings; far below 0 if it looks random."""
    n = F.length(core).cast("double")
    spelt = F.when(encoding.isin("hex", "HEX"), _spelt(core, "abcdef")).otherwise(_spelt(core, LOWER))
    steps = n - 1
    turns = F.regexp_count(core, F.lit(PIECES)) - 1
    even = (steps * ORDINARY_TURNS - turns) / F.sqrt(steps * (ORDINARY_TURNS * (1 - ORDINARY_TURNS) * DISPERSION))
    far = n * (len(DIGITS) * ORDINARY_DIGITS - 1)      # what an ordinary number adds to chi-squared
    k = len(DIGITS) - 1
    digits = (chi - k - far) / F.sqrt(2 * k + 4 * far)
    return F.when(encoding == "decimal", digits).otherwise((F.coalesce(spelt, F.lit(0.0)) + even) / math.sqrt(2))


def battery(token: Column) -> Column:
    """``struct<encoding, n, p, z_chi, z_runs, z_serial, repeats>``; encoding null if none fits."""
    name, alphabet = F.lit(None).cast("string"), F.lit("")
    for label, pattern, letters in reversed(ENCODINGS):
        fits = token.rlike(pattern)
        name, alphabet = F.when(fits, label).otherwise(name), F.when(fits, letters).otherwise(alphabet)

    def tests(x):
        core, letters = x["core"], x["letters"]
        n, k = F.length(core).cast("double"), F.length(letters).cast("double")
        counts = F.transform(F.split(letters, ""), lambda c: F.length(core) - F.length(F.replace(core, c, F.lit(""))))
        chi = k / n * F.aggregate(counts, F.lit(0.0), lambda a, c: a + c.cast("double") * c) - n
        values = F.transform(F.split(core, ""), lambda c: F.instr(letters, c).cast("double") - 1)

        def order(v):
            first, second = F.slice(v, F.lit(1), F.size(v) - 1), F.slice(v, F.lit(2), F.size(v) - 1)
            high = F.aggregate(v, F.lit(0.0), lambda a, w: a + (w >= k / 2).cast("double"))
            turns = F.aggregate(F.zip_with(first, second, lambda a, b: ((a >= k / 2) != (b >= k / 2)).cast("double")), F.lit(1.0), lambda a, w: a + w)
            expected = 2 * high * (n - high) / n + 1
            spread = F.sqrt(F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(1e-9)))

            def serial(mean):
                above = F.aggregate(F.zip_with(first, second, lambda a, b: (a - mean) * (b - mean)), F.lit(0.0), lambda a, w: a + w)
                return above / F.greatest(F.aggregate(v, F.lit(0.0), lambda a, w: a + (w - mean) * (w - mean)), F.lit(1e-9)) * F.sqrt(n)

            return F.struct(((turns - expected) / spread).alias("runs"), _let(_mean(v), serial).alias("serial"))

        def result(y):
            z = ordinary_z(x["name"], core, y["chi"])
            return F.struct(x["name"].alias("encoding"), F.length(core).alias("n"), F.greatest(normal_cdf(z), F.lit(1e-24)).alias("p"),
                            ((y["chi"] - (k - 1)) / F.sqrt(2 * (k - 1))).alias("z_chi"), y["order"]["runs"].alias("z_runs"), y["order"]["serial"].alias("z_serial"),
                            core.rlike(REPEATED).alias("repeats"))

        return _let(F.struct(chi.alias("chi"), _let(values, order).alias("order")), result)

    ready = F.struct(F.regexp_replace(token, "=+$", "").alias("core"), alphabet.alias("letters"), name.alias("name"))
    return _let(ready, tests)


def stratum(encoding: Column, n: Column) -> Column:
    """Encoding and length class (20-31, 32-63, 64-127, ...)."""
    return F.concat_ws(":", encoding, F.floor(F.log2(n.cast("double"))).cast("string"))


def p_bin(p: Column) -> Column:
    return F.least(F.floor(-F.log10(p) * 10).cast("int"), F.lit(BINS - 1))


def thresholds(candidates: DataFrame, q: float = FALSE_DISCOVERIES) -> dict[str, int]:
    """Least bin of each stratum that Benjamini-Hochberg accepts. The candidates
    are ``(stratum, bin)`` rows; a few dozen strata reach the driver."""
    from pyspark.sql import Window

    counts = candidates.groupBy("stratum", "bin").agg(F.count("*").alias("n"))
    w = Window.partitionBy("stratum")
    ranked = counts.withColumn("all", F.sum("n").over(w)).withColumn("found", F.sum("n").over(w.orderBy(F.desc("bin"))))
    # every p in a bin is at most 10^(-bin/10)
    good = ranked.where(F.pow(F.lit(10.0), -F.col("bin") / 10.0) * F.col("all") <= q * F.col("found"))
    return {r["stratum"]: r["bin"] for r in good.groupBy("stratum").agg(F.min("bin").alias("bin")).collect()}


def _of_kind(found: Column, kind_no: int) -> Column:
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind_no).alias("kind_no"), x["end"].alias("end")))


def scan(docs: DataFrame, q: float = FALSE_DISCOVERIES) -> DataFrame:
    """One row per document: ``doc_id`` and ``spans``, an array of
    ``struct<start, kind_no, end>`` in order (``KINDS`` names the kinds)."""
    text = F.col("text")
    rows = docs.select("doc_id", text_of().alias("text"))
    kinds = [spans(text, ASSIGN, 2, 8), spans(text, ACCESS), spans(text, HEX)]
    runs = [F.when(text.rlike(c), F.zip_with(spans(text, c), F.regexp_extract_all(text, F.lit(c), F.lit(0)), lambda at, token: F.struct(at["start"].alias("start"), at["end"].alias("end"), token.alias("token"))))
            .otherwise(F.array().cast("array<struct<start:int,end:int,token:string>>")) for c in CANDIDATES]
    # a part that lies in a longer one is not a candidate of its own
    plain, safe = F.col("plain"), F.col("safe")
    plain = F.filter(plain, lambda c: ~F.exists("safe", lambda d: (d["start"] <= c["start"]) & (c["end"] <= d["end"]) & ((d["start"] < c["start"]) | (c["end"] < d["end"]))))
    safe = F.filter(safe, lambda c: ~F.exists("plain", lambda d: (d["start"] <= c["start"]) & (c["end"] <= d["end"])))
    fixed = F.concat(*(_of_kind(s, k) for k, s in enumerate(kinds)))
    looked = rows.select("doc_id", F.array_sort(fixed).alias("fixed"), runs[0].alias("plain"), runs[1].alias("safe"))
    tested = F.transform(F.concat(plain, safe), lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), battery(c["token"]).alias("b")))
    looked = looked.select("doc_id", "fixed", F.when(F.size(F.concat("plain", "safe")) > 0, tested).alias("tested"))
    apart = F.filter("tested", lambda c: c["b"]["encoding"].isNotNull())
    apart = F.transform(apart, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), stratum(c["b"]["encoding"], c["b"]["n"]).alias("stratum"), p_bin(c["b"]["p"]).alias("bin"),
                                                  ((F.greatest(c["b"]["z_chi"], F.abs(c["b"]["z_runs"]), F.abs(c["b"]["z_serial"])) <= RANDOM_Z) & ~c["b"]["repeats"]).alias("random")))
    looked = store(looked.select("doc_id", "fixed", apart.alias("tested")), "secrets")
    least = thresholds(looked.select(F.explode("tested").alias("c")).select("c.stratum", "c.bin"), q)
    bound = F.create_map(*(F.lit(x) for pair in least.items() for x in pair)) if least else F.create_map().cast("map<string,int>")
    found = F.filter("tested", lambda c: c["random"] & (c["bin"] >= bound[c["stratum"]]))
    found = F.filter(found, lambda c: ~F.exists("fixed", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
    found = _of_kind(F.coalesce(found, F.array().cast("array<struct<start:int,end:int,stratum:string,bin:int,random:boolean>>")), KINDS.index("random"))
    return looked.select("doc_id", "fixed", F.array_sort(F.concat("fixed", found)).alias("spans"))


def printed(found: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", names[s["kind_no"]], s["start"].cast("string"), s["end"].cast("string"))), ",")
