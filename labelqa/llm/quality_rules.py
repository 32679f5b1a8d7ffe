"""Quality rules as a short-circuit cascade.

Each rule is a cheap integer test on one text. A bounded sample of the
documents is scored with every rule to learn what the rule costs (seconds per
text) and how much it rejects; the rules then run in the order of rejection
per cost, and a text that one rule rejects never reaches the next. The order
changes only the time: a text is kept when every rule accepts it.

Defined cases: null text counts as no words and is rejected by ``min_words``;
empty text the same; a null ``doc_id`` is carried through; repeated rows are
judged one by one; an empty table gives an empty result; extra columns are
never read (``kept_documents`` returns them untouched). No length limit.
"""

from __future__ import annotations

import time
from collections import defaultdict
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_of

SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(ord("A"), ord("Z") + 1))
LOWER = bytes(range(ord("a"), ord("z") + 1))


class Facts:
    """Counts of one text, each worked out when first asked for."""

    def __init__(self, text: str):
        self.text = text

    def __getattr__(self, name):        # only called while the value is missing
        value = getattr(Facts, "_" + name)(self)
        self.__dict__[name] = value
        return value

    def _raw(self):
        return self.text.encode("utf-8", "surrogatepass")

    def _words(self):
        return self.raw.split()         # bytes.split breaks at [\x20\x09-\x0D] only

    def _n_words(self):
        return len(self.words)

    def _word_chars(self):
        gaps = len(self.raw) - len(self.raw.translate(None, b" \t\n\r\x0b\x0c"))
        return len(self.text) - gaps

    def _n_symbols(self):
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    def _n_exclaims(self):
        return self.raw.count(b"!")

    def _n_upper(self):
        return len(self.raw) - len(self.raw.translate(None, UPPER))

    def _n_lower(self):
        return len(self.raw) - len(self.raw.translate(None, LOWER))

    def _lines(self):
        return [x for x in self.raw.split(b"\n") if x.strip()]

    def _n_lines(self):
        return len(self.lines)

    def _n_dup_lines(self):
        return self.n_lines - len(set(self.lines))

    def _ids(self):
        numbers = defaultdict(count().__next__)
        return np.fromiter(map(numbers.__getitem__, self.words), np.int64, self.n_words)

    def _n_adjacent(self):
        return int(np.count_nonzero(self.ids[1:] == self.ids[:-1]))

    def _n_repeat_words(self):
        """Words inside 3-word windows that the text holds twice or more."""
        n = self.n_words
        if n < 4:
            return 0
        ids = self.ids
        size = int(ids.max()) + 1
        pairs = ids[:-1] * size + ids[1:]
        if size >= 1 << 20:             # keep the product below inside 64 bits
            pairs = np.unique(pairs, return_inverse=True)[1]
        _, place, often = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True, return_counts=True)
        again = often[place] > 1
        inside = np.zeros(n, bool)
        for k in range(3):
            inside[k:n - 2 + k] |= again
        return int(np.count_nonzero(inside))


@dataclass(frozen=True)
class Rule:
    """``share`` per cent of ``per`` is the most (or least) that ``fact`` may reach."""

    name: str
    fact: str
    per: str | None
    share: int
    least: bool = False

    def accepts(self, facts: Facts) -> bool:
        value = getattr(facts, self.fact)
        if self.per is None:
            return value >= self.share if self.least else value <= self.share
        bound = self.share * getattr(facts, self.per)
        return 100 * value >= bound if self.least else 100 * value <= bound


BASE = (Rule("min_words", "n_words", None, 50, least=True),
        Rule("repeated_windows", "n_repeat_words", "n_words", 50))
RULES = (Rule("symbols", "n_symbols", "n_words", 25),
         Rule("exclaims", "n_exclaims", "n_words", 50),
         Rule("capitals", "n_upper", "n_lower", 100),
         Rule("duplicate_lines", "n_dup_lines", "n_lines", 50),
         Rule("adjacent_words", "n_adjacent", "n_words", 20),
         Rule("long_words", "word_chars", "n_words", 2000),
         Rule("short_words", "word_chars", "n_words", 150, least=True))


def measure(docs: DataFrame, rules=BASE + RULES, sample_rows: int = 2000, seed: int = 7) -> list[dict]:
    """Cost (seconds a text) and rejections of each rule over a sample of about
    ``sample_rows`` documents. One row per rule and task reaches the driver."""
    n = docs.count()
    if not n:
        return [{"rule": r.name, "cost": 0.0, "rejects": 0.0} for r in rules]
    part = docs.select(text_of().alias("text")).sample(fraction=min(1.0, sample_rows / n), seed=seed)

    def probe(batches):
        spent, out, rows = [0.0] * len(rules), [0] * len(rules), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                rows += 1
                for k, rule in enumerate(rules):
                    facts = Facts(text)     # fresh: every rule pays for its own facts
                    start = time.perf_counter()
                    out[k] += not rule.accepts(facts)
                    spent[k] += time.perf_counter() - start
        yield pa.RecordBatch.from_pydict({"rule": [r.name for r in rules], "spent": spent, "out": out, "rows": [rows] * len(rules)})

    seen = (part.mapInArrow(probe, "rule string, spent double, out long, rows long").groupBy("rule")
            .agg(F.sum("spent").alias("spent"), F.sum("out").alias("out"), F.sum("rows").alias("rows")).collect())
    by = {r["rule"]: r for r in seen}
    return [{"rule": r.name, "cost": by[r.name]["spent"] / max(1, by[r.name]["rows"]), "rejects": by[r.name]["out"] / max(1, by[r.name]["rows"])}
            if r.name in by else {"rule": r.name, "cost": 0.0, "rejects": 0.0} for r in rules]


def plan(docs: DataFrame, rules=BASE + RULES, **sample) -> tuple[Rule, ...]:
    """The rules by falling rejection per cost; ties keep the order given."""
    seen = {x["rule"]: x for x in measure(docs, rules, **sample)}
    worth = lambda r: seen[r.name]["rejects"] / max(seen[r.name]["cost"], 1e-9)
    return tuple(sorted(rules, key=worth, reverse=True))


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
REPORT = T.StructType([*(T.StructField(f, T.LongType()) for f in FIELDS), T.StructField("base_failed", T.BooleanType()),
                       T.StructField("kept", T.BooleanType()), T.StructField("failed_rule", T.StringType())])


def first_failure(facts: Facts, order) -> str | None:
    return next((rule.name for rule in order if not rule.accepts(facts)), None)


def verdict(text: Column, order) -> Column:
    """The first rule of the cascade that rejects the text, null if none does."""

    @F.arrow_udf("string")
    def judge(texts: pa.Array) -> pa.Array:
        return pa.array([first_failure(Facts(t or ""), order) for t in texts.to_pylist()], pa.string())

    return judge(text)


def report(text: Column, order) -> Column:
    """The counts of every text, and the cascade for those that pass the base rules."""

    @F.arrow_udf(REPORT)
    def judge(texts: pa.Array) -> pa.Array:
        rows = []
        for text in texts.to_pylist():
            facts = Facts(text or "")
            failed = first_failure(facts, BASE)
            base = failed is not None
            failed = failed or first_failure(facts, order)
            rows.append({f: getattr(facts, f) for f in FIELDS} | {"base_failed": base, "kept": failed is None, "failed_rule": failed})
        return pa.array(rows, pa.struct([*(pa.field(f, pa.int64()) for f in FIELDS), pa.field("base_failed", pa.bool_()), pa.field("kept", pa.bool_()), pa.field("failed_rule", pa.string())]))

    return judge(text)


def kept_documents(docs: DataFrame, **sample) -> DataFrame:
    """The rows that every rule accepts, all columns as they came; no shuffle."""
    order = plan(docs, **sample)
    return docs.where(verdict(text_of(), order).isNull())
