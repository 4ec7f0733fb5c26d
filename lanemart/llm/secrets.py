"""Secret scan by a trigram inverted index, in DataFrame operations only.

1. From each rule's regex a Boolean trigram query is derived: an OR of clauses, each a set of trigrams that a
   match must contain (``required_trigrams``). Letters are compared in lower case.
2. ``postings`` is the inverted index over the trigrams that any query asks for: ``(trigram, id)``.
3. ``candidates`` intersects postings: an id satisfies a clause when it is in the postings of all its trigrams.
4. Only candidates of a rule are run through its regex, in a second pass over whole texts. Rules without
   mandatory trigrams (a run of hex digits) are run over every text.

Offsets are code points, end exclusive; matches of a rule are leftmost and do not overlap, and matches that
fail the rule's length are dropped after they have been taken.

Defined cases: null text counts as empty. Rows with a null id share one candidate entry, so each of them is
verified if one of them is a candidate; the same holds for repeated ids. An empty table gives an empty result.
Further columns do not matter. Texts may hold any number of matches: offsets are summed in two levels.
"""

from __future__ import annotations

import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lanemart.llm.common import broadcast_if_small, cut

#: Candidate ids up to which they are broadcast to the second pass; beyond, the join is shuffled.
BROADCAST_ROWS = 1_000_000
#: Matches whose lengths are summed at a time.
RUN = 512
#: Most clauses and literals the derivation spells out; beyond, it asks for less, which only adds candidates.
MOST_CLAUSES = 64


@dataclass(frozen=True)
class Rule:
    """``pattern`` is a regex; a match counts if ``group`` of it has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The lengths of access and hex runs stand in the pattern: a shorter run holds no other match.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Further kinds that the index makes cheap to look for.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{15,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
)

ANY = frozenset([frozenset()])


def _grams(texts) -> frozenset:
    return frozenset(frozenset(t[k : k + 3] for k in range(len(t) - 2)) for t in texts)


def _and(left: frozenset, right: frozenset) -> frozenset:
    both = {a | b for a, b in product(left, right)}
    both = frozenset(a for a in both if not any(b < a for b in both))
    return both if len(both) <= MOST_CLAUSES else left


def _derive(nodes) -> tuple[frozenset, frozenset | None]:
    """What a match of the nodes must contain, and all texts it can be (None where they are not listed)."""
    clauses, run, listed = ANY, frozenset([""]), True
    for node in nodes:
        needs, texts = _one(*node)
        if texts is not None and len(run) * len(texts) <= MOST_CLAUSES:
            run = frozenset(a + b for a, b in product(run, texts))
        else:
            clauses, run, listed = _and(_and(clauses, _grams(run)), needs), frozenset([""]), False
    return _and(clauses, _grams(run)), run if listed else None


def _one(op, value) -> tuple[frozenset, frozenset | None]:
    kind = str(op)
    if kind == "LITERAL":
        return ANY, frozenset([chr(value).lower()])
    if kind == "IN" and len(value) <= 8 and all(str(o) == "LITERAL" for o, _ in value):
        return ANY, frozenset(chr(c).lower() for _, c in value)
    if kind == "SUBPATTERN":
        return _derive(value[3])
    if kind == "BRANCH":
        parts = [_derive(p) for p in value[1]]
        texts = None if any(t is None for _, t in parts) else frozenset().union(*(t for _, t in parts))
        return frozenset().union(*(c for c, _ in parts)), texts
    if kind in ("MAX_REPEAT", "MIN_REPEAT"):
        least, most, inner = value
        needs, texts = _derive(inner)
        if least == 0:
            return ANY, texts | {""} if texts is not None and most == 1 else None
        return needs, None
    return ANY, None


def required_trigrams(pattern: str) -> list[frozenset[str]]:
    """The trigram query of a regex: a match contains all trigrams of at least one of these sets.

    An empty list means that nothing is mandatory. The parse tree is that of Python's own regex module.
    """
    clauses, _ = _derive(parser.parse(pattern))
    return [] if frozenset() in clauses else sorted(clauses, key=sorted)


def postings(docs: DataFrame, grams: list[str], id_column: str, text_column: str) -> DataFrame:
    """The inverted index over ``grams``: ``(gram, id)``, an entry for each row that holds the trigram."""
    lowered = F.lower(F.coalesce(F.col(text_column), F.lit("")))
    held = docs.select(F.col(id_column).alias("id"), lowered.alias("t"))
    present = F.array_compact(F.array(*[F.when(F.contains("t", F.lit(g)), F.lit(g)) for g in grams]))
    return held.select("id", F.explode(present).alias("gram"))


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """``(id, rules)``: the rules whose trigram query the id satisfies, by intersecting postings."""
    asked = [(kind, n, gram, len(c)) for kind, clauses in queries.items() for n, c in enumerate(clauses) for gram in c]
    entries = [F.struct(*(F.lit(v).alias(c) for c, v in zip(("kind", "clause", "gram", "needed"), row))) for row in asked]
    plan = index.sparkSession.range(1).select(F.inline(F.array(*entries)))
    hits = index.join(F.broadcast(plan), "gram").groupBy("id", "kind", "clause", "needed")
    met = hits.agg(F.count_distinct("gram").alias("n")).filter("n = needed")
    return met.groupBy("id").agg(F.collect_set("kind").alias("rules"))


def _running(values: Column) -> Column:
    """Running sums of an array, in runs of ``RUN`` so that no array is copied once per element."""

    def add(total, value):
        return F.concat(total, F.array(F.element_at(total, -1) + value))

    runs = F.transform(F.sequence(F.lit(0), F.size(values) - 1, F.lit(RUN)), lambda k: F.slice(values, k + 1, RUN))
    sums = F.transform(runs, lambda r: F.aggregate(r, F.lit(0), lambda a, b: a + b))
    starts = F.aggregate(sums, F.array(F.lit(0)), add)
    inside = F.zip_with(runs, F.slice(starts, 1, F.size(runs)), lambda r, s: F.slice(F.aggregate(r, F.array(s), add), 2, RUN))
    return F.when(F.size(values) == 0, F.array().cast("array<int>")).otherwise(F.flatten(inside))


def _with_spans(df: DataFrame, rule: Rule, rank: int, text: Column) -> DataFrame:
    """Add ``__s_<kind>``: structs (start, rank, end) of the matches that count."""
    hits, kept, gaps, name = "__hits", "__kept", "__gaps", f"__s_{rule.kind}"
    pattern = F.lit(rule.pattern)
    df = df.withColumn("__t", text)
    df = df.withColumn("__t", F.when(F.col("__t").rlike(rule.pattern), F.col("__t")).otherwise(F.lit("")))
    df = df.withColumns(
        {
            hits: F.transform(F.regexp_extract_all("__t", pattern, F.lit(0)), F.length),
            kept: F.transform(F.regexp_extract_all("__t", pattern, F.lit(rule.group)), F.length),
            gaps: F.transform(F.split("__t", rule.pattern, -1), F.length),
        }
    )
    df = df.withColumn("__end", _running(F.zip_with(F.slice(gaps, 1, F.size(hits)), hits, lambda g, h: g + h)))
    spans = F.zip_with("__end", F.arrays_zip(hits, kept), lambda e, m: F.struct(
        (e - m[hits]).alias("start"), F.lit(rank).alias("rank"), e.alias("end"), m[kept].alias("size")
    ))
    df = df.withColumn(name, F.filter(spans, lambda s: s["size"] >= rule.least))
    return df.drop("__t", hits, kept, gaps, "__end")


def _digest(spans: Column, kinds: list[str]) -> Column:
    names = F.array(*[F.lit(k) for k in kinds])
    said = F.transform(F.sort_array(spans), lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"], s["end"]))
    return F.array_join(said, ",")


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = (*BASE, *MORE), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per document: its id as ``id`` and for each rule ``__s_<kind>``, its spans."""
    queries = {r.kind: required_trigrams(r.pattern) for r in rules}
    grams = sorted({g for clauses in queries.values() for c in clauses for g in c})
    found = cut(candidates(postings(docs, grams, id_column, text_column), queries))
    found = broadcast_if_small(found.select(F.col("id").alias("__id"), "rules"), BROADCAST_ROWS)
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column), F.lit("")).alias("__text"))
    rows = rows.join(found, F.col("id").eqNullSafe(F.col("__id")), "left").drop("__id")
    for rank, rule in enumerate(rules):
        text = F.col("__text")
        if queries[rule.kind]:
            text = F.when(F.array_contains("rules", rule.kind), text).otherwise(F.lit(""))
        rows = _with_spans(rows, rule, rank, text)
    return rows.drop("__text", "rules")


def secret_spans(
    docs: DataFrame, more: tuple[Rule, ...] = MORE, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Counts per base kind, the digest of the base spans, and all spans as text, per document."""
    rules = (*BASE, *more)
    kinds = [r.kind for r in rules]
    found = scan(docs, rules, id_column, text_column)
    base = F.concat(*[F.col(f"__s_{r.kind}") for r in BASE])
    every = F.concat(*[F.col(f"__s_{k}") for k in kinds])
    return found.select(
        F.col("id").alias(id_column),
        *[F.size(f"__s_{r.kind}").cast("long").alias(f"n_{r.kind}") for r in BASE],
        F.sha2(_digest(base, kinds), 256).alias("base_sha256"),
        _digest(every, kinds).alias("spans"),
    )
