"""Secret scans through an inverted index of trigrams.

From each rule's pattern a Boolean trigram query is derived: any text that matches must satisfy
it. Documents are indexed by the trigrams of their lower-cased text, the postings of each
conjunction are intersected, and only the documents found are verified with the pattern. The documents
found reach the texts as broadcast bitmaps of their row numbers, so that texts aren't shuffled. A rule
whose pattern has no mandatory trigram (a bare run of hex digits) scans every document.

Spans are counted in code points, end exclusive, leftmost and non-overlapping per kind. Native
DataFrame functions only.
"""

import re
from dataclasses import dataclass
from itertools import product
from re import _parser as grammar

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from teamlines.llm.common import MOST_BUCKETS, numbered, rows_of, with_flags

MOST_STRINGS = 64  # a longer list of alternatives ends an exact run of the pattern
WIDEST_CLASS = 8  # a wider character class ends it too


@dataclass(frozen=True)
class Rule:
    """``pattern`` is read alike by Java and by Python's grammar; a match counts if ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# Kinds and patterns of the base rules, in the order in which ties are listed.
BASE = (
    Rule(
        "assign",
        r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        group=2,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}", least=16),  # the same spans as runs of any length, then those of 16 or more
)
# Further rules that the method adds.
EXTRA = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
RULES = BASE + EXTRA


# -- Boolean queries: a set of conjunctions, each a frozenset of trigrams; {frozenset()} is always true --

ANY = frozenset([frozenset()])


def _least(conjunctions):
    """Without the conjunctions that another one implies."""
    return frozenset(c for c in conjunctions if not any(d < c for d in conjunctions))


def _both(left, right):
    return _least({a | b for a, b in product(left, right)})


def _of_strings(strings):
    """One of ``strings`` occurs: the trigrams of any of them."""
    return _least({frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings})


def _exact(op, arg):
    """The only strings that a node matches, lower-cased; None if they are many."""
    if op is grammar.LITERAL:
        return {chr(arg).lower()}
    if op is grammar.IN:
        if any(kind is not grammar.LITERAL for kind, _ in arg) or len(arg) > WIDEST_CLASS:
            return None
        return {chr(c).lower() for _, c in arg}
    if op is grammar.MAX_REPEAT:
        low, high, inner = arg
        inside = _exact_all(inner)
        return inside | {""} if inside is not None and (low, high) == (0, 1) else None
    if op is grammar.SUBPATTERN:
        return _exact_all(arg[-1])
    if op is grammar.BRANCH:
        sides = [_exact_all(x) for x in arg[1]]
        return None if None in sides else set().union(*sides)
    return None


def _exact_all(nodes):
    found = {""}
    for op, arg in nodes:
        here = _exact(op, arg)
        if here is None or len(found) * len(here) > MOST_STRINGS:
            return None
        found = {a + b for a, b in product(found, here)}
    return found


def _query(nodes):
    """What any match of the sequence needs. Runs of exact nodes are joined before trigrams are taken."""
    need, run = ANY, {""}
    for op, arg in nodes:
        here = _exact(op, arg)
        if here is not None and len(run) * len(here) <= MOST_STRINGS:
            run = {a + b for a, b in product(run, here)}
            continue
        need = _both(need, _of_strings(run))
        run = {""} if here is None else here
        if here is None:
            need = _both(need, _inside(op, arg))
    return _both(need, _of_strings(run))


def _inside(op, arg):
    if op is grammar.SUBPATTERN:
        return _query(arg[-1])
    if op is grammar.BRANCH:
        return _least(frozenset().union(*[_query(x) for x in arg[1]]))
    if op is grammar.MAX_REPEAT and arg[0] > 0:
        return _query(arg[2])
    return ANY


def trigram_query(pattern):
    """The conjunctions of lower-case trigrams one of which every matching text holds."""
    return _query(list(grammar.parse(pattern, re.ASCII)))


# -- index and search --


def postings(rows: DataFrame, trigrams):
    """``trigram, row_id``: the inverted index of ``rows.text`` for the trigrams that the queries ask for."""
    low = F.lower("text")
    held = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in sorted(trigrams)]))
    return rows.select("row_id", F.explode(held).alias("trigram"))


def candidates(rows: DataFrame, rules):
    """``row_id, kinds``: rows that satisfy the query of each kind, by intersecting postings."""
    wanted = [
        (rule.kind, i, trigram, len(conjunction))
        for rule in rules
        for i, conjunction in enumerate(sorted(trigram_query(rule.pattern), key=sorted))
        for trigram in sorted(conjunction)
    ]
    asked = rows.sparkSession.createDataFrame(wanted, "kind string, part int, trigram string, needed int")
    lists = postings(rows, {t for _, _, t, _ in wanted}).join(F.broadcast(asked), "trigram")  # as many rows as rules have trigrams
    met = lists.groupBy("row_id", "kind", "part", "needed").agg(F.count("*").alias("n")).where("n = needed")
    return met.groupBy("row_id").agg(F.collect_set("kind").alias("kinds"))


def _lengths(text, rule, place):
    """For each match the characters since the last one and its own, and whether it counts."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    gaps = F.split(text, rule.pattern, -1)
    told = whole if rule.group == 0 else F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    return F.transform(
        F.arrays_zip(whole.alias("whole"), F.slice(gaps, 1, F.size(whole)).alias("gap"), told.alias("told")),
        lambda m, i: F.struct(
            F.lit(place).alias("place"),
            i.alias("nth"),
            F.length(m["gap"]).cast("long").alias("gap"),
            F.length(m["whole"]).cast("long").alias("chars"),
            (F.length(m["told"]) >= rule.least).alias("counts"),
        ),
    )


def find_secrets(docs: DataFrame, rules=RULES, base=BASE, text="text", doc_id="doc_id", most=MOST_BUCKETS):
    """One row per row of ``docs``: ``row_id, doc_id``, a count per kind (``n_<kind>``), ``spans`` and ``base_sha256``.

    ``spans`` is ``kind:start:end`` of all kinds by start, then kind in the order of ``rules``;
    ``base_sha256`` is the digest of that string for the base kinds alone. A null or empty text
    has no spans. Repeated rows each get their own result; spans that tie go by kind. Very long texts are
    scanned whole. An empty table gives no rows. Only the named columns are read, under names of their own.
    """
    rules = tuple(rules)
    indexed = [r for r in rules if ANY != trigram_query(r.pattern)]
    rows = rows_of(numbered(docs), doc_id=doc_id, text=text).withColumn("text", F.coalesce("text", F.lit("")))
    asked = {f"asked_{r.kind}": F.array_contains("kinds", r.kind) for r in indexed}
    searched = with_flags(rows, candidates(rows, indexed), most, **asked) if indexed else rows
    none = F.array().cast("array<struct<place:int,nth:int,gap:bigint,chars:bigint,counts:boolean>>")
    parts = []
    for place, rule in enumerate(rules):
        lengths = _lengths(F.col("text"), rule, place)
        if rule in indexed:
            lengths = F.when(F.col(f"asked_{rule.kind}"), lengths).otherwise(none)
        parts.append(lengths)
    matches = searched.select("row_id", "doc_id", F.concat(*parts).alias("matches"))
    # Starts are running totals within a document and kind, so a text of many matches costs a sort, not a square.
    each = matches.select("row_id", "doc_id", F.explode_outer("matches").alias("m")).select("row_id", "doc_id", "m.*")
    end = F.expr("sum(gap + chars) over (partition by row_id, place order by nth)")
    placed = each.withColumn("end", end).withColumn("start", F.col("end") - F.col("chars"))
    kind = F.element_at(F.array(*[F.lit(r.kind) for r in rules]), F.col("place") + 1)
    span = F.struct("start", "place", F.concat_ws(":", kind, "start", "end").alias("said"))
    told = F.when(F.col("counts"), span)
    from_base = F.col("place").isin([i for i, r in enumerate(rules) if r in base])
    counted = [F.count(F.when(F.col("counts") & (F.col("place") == i), 1)).alias(f"n_{r.kind}") for i, r in enumerate(rules)]
    found = placed.groupBy("row_id", F.col("doc_id").alias("id")).agg(
        *counted,
        F.collect_list(told).alias("all_spans"),
        F.collect_list(F.when(from_base, told)).alias("base_spans"),
    )
    joined = lambda name: F.array_join(F.transform(F.array_sort(name), lambda s: s["said"]), ",")
    return found.select(
        "row_id",
        F.col("id").alias("doc_id"),
        *[f"n_{r.kind}" for r in rules],
        F.sha2(joined("base_spans"), 256).alias("base_sha256"),
        joined("all_spans").alias("spans"),
    )
