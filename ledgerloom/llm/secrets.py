"""Secret scans [native]: a trigram inverted index in front of the rules' expressions.

The Boolean trigram query of a rule is derived from its expression: the driver parses it and multiplies out the
strings that its fixed parts can spell, as an OR of ANDs of lower-case trigrams, one of which the lower-cased
text of any match contains. Parts that can spell too much (wide classes, open repetitions) end a string.

The index holds postings (trigram, key) for the trigrams that some rule asks for; the key is a hash of a row's id
and text. Postings are intersected by key, a bit a trigram: a key is a candidate of a rule when it has all
trigrams of one of the rule's ANDs. Candidates are few and go to the texts: by broadcast while they are counted
to be few, else by a shuffle join of those texts alone that pass the query; no other text moves. Only candidates
are verified with the rule's expression; rules without a mandatory trigram (long hex) scan every text.

Positions come from Spark's own functions: the pieces between matches (``split``) and the matches
(``regexp_extract_all``) alternate, so running sums of their lengths are the spans, in code points. The sums are
taken in runs of ``RUN`` matches, then over the runs, so their cost is linear for all texts that fit a row.

Defined results: a null text counts as empty and has no spans; an empty table gives no rows; repeated rows are
scanned each; rows with a null id are kept; extra columns are ignored.
"""

from __future__ import annotations

import re._constants as rx
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import materialize, spread

#: Strings that the derivation multiplies out at most, letters of a class that it spells, and ANDs of a query.
STRINGS, LETTERS, ANDS = 64, 16, 128
#: Bits of one mask of trigrams.
MASK = 60
RUN = 256
#: Candidates that are broadcast at most.
BROADCAST_ROWS = 200_000
_SPANS = "array<struct<a:int,k:string,b:int>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""

BASE_RULES = (
    Rule("assign", ASSIGN, 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]+", 0, 32),
)

MORE_RULES = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"),
    Rule("repo_token", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]+", 0, 14),
)

# --- the trigram query of an expression -----------------------------------------------------------------------

Query = frozenset  # of frozensets of trigrams: an OR of ANDs
TRUE: Query = frozenset([frozenset()])


def _either(a: Query, b: Query) -> Query:
    every = a | b
    least = frozenset(x for x in every if not any(y < x for y in every))
    return least if len(least) <= ANDS else TRUE


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > ANDS:  # the one that says more stays; a weaker query only verifies more
        return min(a, b, key=lambda q: (q == TRUE, len(q)))
    return _either(frozenset(x | y for x in a for y in b), frozenset())


def _grams(strings: frozenset[str]) -> Query:
    out: Query = frozenset()
    for s in strings:
        out = _either(out, frozenset([frozenset(s[i : i + 3] for i in range(len(s) - 2))]))
    return out


def _letters(items: list) -> frozenset[str] | None:
    """The characters of a class in lower case, if it spells few and plain ones."""
    out: set[int] = set()
    for op, value in items:
        if op is rx.LITERAL:
            out.add(value)
        elif op is rx.RANGE and value[1] - value[0] < LETTERS:
            out.update(range(value[0], value[1] + 1))
        else:
            return None
    return frozenset(chr(c).lower() for c in out) if len(out) <= LETTERS and max(out, default=0) < 128 else None


def _node(op, value) -> tuple[frozenset[str] | None, Query]:
    """What one part spells (None: too much to list), and the query that it sets by itself."""
    if op is rx.LITERAL:
        return (frozenset([chr(value).lower()]), TRUE) if value < 128 else (None, TRUE)
    if op is rx.IN:
        return _letters(value), TRUE
    if op in (rx.AT, rx.ASSERT, rx.ASSERT_NOT):
        return frozenset([""]), TRUE  # no width
    if op is rx.SUBPATTERN:
        return _sequence(value[3])
    if op is rx.ATOMIC_GROUP:
        return _sequence(value)
    if op is rx.BRANCH:
        found = [_sequence(part) for part in value[1]]
        strings = frozenset().union(*(s or () for s, _ in found))
        if all(s is not None for s, _ in found) and len(strings) <= STRINGS:
            return strings, TRUE
        query: Query = frozenset()
        for s, q in found:
            query = _either(query, q if s is None else _grams(s))
        return None, query
    if op in (rx.MAX_REPEAT, rx.MIN_REPEAT, rx.POSSESSIVE_REPEAT):
        low, high, part = value
        strings, query = _sequence(part)
        if strings is not None and high is not rx.MAXREPEAT and high <= 64:
            out, times = frozenset([""] if low == 0 else []), frozenset([""])
            for n in range(1, high + 1):
                times = frozenset(a + b for a in times for b in strings)
                if n >= low:
                    out |= times
                if len(times) > STRINGS or len(out) > STRINGS:
                    break
            else:
                return out, TRUE
        return None, TRUE if low == 0 else query if strings is None else _grams(strings)
    return None, TRUE  # any character, negated classes, references


def _sequence(parts) -> tuple[frozenset[str] | None, Query]:
    query, run, whole = TRUE, frozenset([""]), True
    for op, value in parts:
        strings, own = _node(op, value)
        if strings is not None and len(strings) * len(run) <= STRINGS:
            run = frozenset(a + b for a in run for b in strings)
            continue
        whole = False
        query = _both(_both(query, _grams(run)), own)
        run = frozenset([""]) if strings is None else strings
    return (run, TRUE) if whole else (None, _both(query, _grams(run)))


def trigram_query(pattern: str) -> Query:
    """An OR of ANDs of trigrams: the lower-cased text of every match of ``pattern`` has all of one AND. ``TRUE``
    (an empty AND) if the expression has no mandatory trigram."""
    strings, query = _sequence(parser.parse(pattern))
    return query if strings is None else _grams(strings)


# --- index, candidates, spans ---------------------------------------------------------------------------------


def wanted_trigrams(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({t for rule in rules for part in trigram_query(rule.pattern) for t in part})


def postings(rows: DataFrame, wanted: list[str]) -> DataFrame:
    """Inverted index (trigram as its place in ``wanted``, _key) from rows (_key, _text)."""
    present = F.array_compact(F.array(*(F.when(F.col("_low").contains(t), F.lit(n)) for n, t in enumerate(wanted))))
    return rows.select("_key", F.lower("_text").alias("_low")).select("_key", F.explode(present).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...], wanted: list[str]) -> DataFrame:
    """(_key, _kinds): postings intersected by key; bit n of ``_kinds`` is set where rule n may match."""
    words = range(0, len(wanted), MASK)
    bit = lambda low: F.when(
        F.col("trigram").between(low, low + MASK - 1), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("trigram") - low)
    ).otherwise(F.lit(0).cast("long"))
    held = index.groupBy("_key").agg(*(F.bit_or(bit(low)).alias(f"_w{low}") for low in words))
    kinds = F.lit(0).cast("long")
    for n, rule in enumerate(rules):
        query = trigram_query(rule.pattern)
        if query == TRUE:
            continue
        meets = F.lit(False)
        for part in sorted(query, key=sorted):
            places = [wanted.index(t) for t in part]
            for low in words:
                mask = sum(1 << (p - low) for p in places if low <= p < low + MASK)
                own = F.col(f"_w{low}").bitwiseAND(F.lit(mask).cast("long")) == mask
                every = own if low == 0 else every & own
            meets = meets | every
        kinds = kinds.bitwiseOR(F.when(meets, F.lit(1 << n).cast("long")).otherwise(F.lit(0).cast("long")))
    return held.select("_key", kinds.alias("_kinds")).filter("_kinds <> 0")


def _passes(low: Column, rules: tuple[Rule, ...]) -> Column:
    """Whether a lower-cased text has the trigrams of some rule."""
    out = F.lit(False)
    for rule in rules:
        for part in sorted(trigram_query(rule.pattern), key=sorted):
            every = F.lit(bool(part))
            for t in sorted(part):
                every = every & low.contains(t)
            out = out | every
    return out


def _pattern(rule: Rule) -> str:
    # a run of hex digits of the least length starts where a run starts and takes all of it
    return r"(?<![0-9a-f])[0-9a-f]{32,}+" if rule.kind == "hex" else rule.pattern


def _pairs(text: Column, hits: Column, rule: Rule) -> Column:
    """Array of (g, h, kept): the lengths of the piece before a match and of the match, and whether it counts."""
    pattern = _pattern(rule)
    value = (lambda h: F.regexp_extract(h, pattern, rule.group)) if rule.group else (lambda h: h)
    return F.zip_with(
        F.slice(F.split(text, pattern, -1), 1, F.size(hits)), hits,
        lambda g, h: F.struct(F.length(g).alias("g"), F.length(h).alias("h"), (F.length(value(h)) >= rule.least).alias("kept")),
    )


def _spans(pairs: Column, rule: Rule) -> Column:
    """Array of structs (a, k, b) of the kept matches: start, kind's name, end."""
    step = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
    run = lambda c: F.slice(pairs, c * RUN + 1, RUN)
    runs = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / RUN).cast("int"))
    sums = F.transform(runs, lambda c: F.aggregate(run(c), F.lit(0), lambda acc, x: acc + x["g"] + x["h"]))
    starts = F.slice(F.aggregate(sums, F.array(F.lit(0)), step), 1, F.size(runs))
    placed = F.zip_with(
        runs, starts,
        lambda c, at: F.zip_with(
            run(c), F.slice(F.aggregate(F.transform(run(c), lambda x: x["g"] + x["h"]), F.array(at), step), 1, F.size(run(c))),
            lambda x, s: F.struct((s + x["g"]).alias("a"), F.lit(rule.kind).alias("k"), (s + x["g"] + x["h"]).alias("b"), x["kept"].alias("kept")),
        ),
    )
    return F.transform(F.filter(F.flatten(placed), lambda s: s["kept"]), lambda s: F.struct(s["a"].alias("a"), s["k"].alias("k"), s["b"].alias("b")))


def _joined(spans: Column, order: list[str]) -> Column:
    """kind:start:end by start, then kind in the given order, comma-joined."""
    place = lambda s: F.array_position(F.array(*map(F.lit, order)), s["k"])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(s["a"].alias("a"), place(s).alias("p"), s["b"].alias("b"), s["k"].alias("k"))))
    return F.array_join(F.transform(keyed, lambda s: F.concat_ws(":", s["k"], s["a"], s["b"])), ",")


def scan_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: tuple[Rule, ...] = BASE_RULES, more: tuple[Rule, ...] = MORE_RULES,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One row a row of ``docs``: id, n_<kind> for the base rules, base_sha256, spans (base and further rules)."""
    rules = base + more
    if len(rules) > MASK:
        raise ValueError(f"more than {MASK} rules at once")
    wanted = wanted_trigrams(rules)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = spread(docs.select(F.col(id_col), F.col(text_col))).select(F.col(id_col), text.alias("_text"), F.xxhash64(F.col(id_col), text).alias("_key"))
    none = lambda kind: F.expr(f"cast(array() as {kind})")
    if wanted:
        found = materialize(candidates(postings(source.select("_key", "_text"), wanted), rules, wanted))
        if found.limit(broadcast_rows + 1).count() <= broadcast_rows:
            joined = source.join(F.broadcast(found), "_key", "left")
        else:
            passes = _passes(F.lower("_text"), rules)
            joined = source.filter(passes).join(found, "_key", "left").unionByName(source.filter(~passes).withColumn("_kinds", F.lit(None).cast("long")))
    else:
        joined = source.withColumn("_kinds", F.lit(None).cast("long"))
    may = lambda n: F.coalesce(F.col("_kinds"), F.lit(0).cast("long")).bitwiseAND(F.lit(1 << n).cast("long")) != 0
    state = joined.select(id_col, "_text", "_kinds")
    hits = {
        n: F.regexp_extract_all("_text", F.lit(_pattern(r)), F.lit(0)) if trigram_query(r.pattern) == TRUE
        else F.when(may(n), F.regexp_extract_all("_text", F.lit(_pattern(r)), F.lit(0))).otherwise(none("array<string>"))
        for n, r in enumerate(rules)
    }
    state = state.select(id_col, "_text", *(h.alias(f"_h{n}") for n, h in hits.items()))
    pair_type = "array<struct<g:int,h:int,kept:boolean>>"
    pairs = [F.when(F.size(f"_h{n}") > 0, _pairs(F.col("_text"), F.col(f"_h{n}"), r)).otherwise(none(pair_type)) for n, r in enumerate(rules)]
    state = state.select(id_col, *(p.alias(f"_p{n}") for n, p in enumerate(pairs)))
    spans = [F.when(F.size(f"_p{n}") > 0, _spans(F.col(f"_p{n}"), r)).otherwise(none(_SPANS)) for n, r in enumerate(rules)]
    out = state.select(id_col, *(s.alias(f"_{r.kind}") for r, s in zip(rules, spans, strict=True)))
    order = [r.kind for r in rules]
    base_kinds = [r.kind for r in base]
    every = F.concat(*(F.col(f"_{k}") for k in order))
    based = F.concat(*(F.col(f"_{k}") for k in base_kinds))
    return out.select(
        id_col,
        *(F.size(f"_{k}").cast("long").alias(f"n_{k}") for k in base_kinds),
        F.sha2(_joined(based, order), 256).alias("base_sha256"),
        _joined(every, order).alias("spans"),
    )
