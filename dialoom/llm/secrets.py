"""Secret scans by a trigram inverted index, on DataFrame functions alone.

From each rule's regular expression a Boolean query over trigrams is derived that every match must satisfy: an OR of ANDs.
The index holds postings (trigram, document) for the trigrams that the rules ask for; postings are intersected, and only the
candidates are verified with the expression itself. Rules that force no trigram scan every text.

Defined results: a null text counts as empty; rows that repeat give one result each; an empty table gives no rows; further
columns of the input are ignored by `scan`; a null identifier is a value like any other. Texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dialoom.llm.common import boxed, settle, table

#: A clause holds trigrams that must all occur; a query is true if one of its clauses is.
Query = frozenset[frozenset[str]]
ALWAYS: Query = frozenset([frozenset()])
#: Sets of literals or clauses larger than this are given up for a weaker query.
MOST = 64


@dataclass(frozen=True)
class Rule:
    """kind, expression (one that Java, RE2 and Python read alike), the group that holds the secret and its least length."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


#: The three base kinds, in their order.
BASE = (
    Rule("assign", "(" + "|".join(map(_either, ("password", "passwd", "secret", "token"))) + "|" + _either("api") + "_?" + _either("key") + ")[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]+", 0, 24),
)
MORE = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("chat_token", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("host_token", "gh[opsu]_[A-Za-z0-9]+", 0, 40),
    Rule("web_token", "eyJ[A-Za-z0-9_-]+\\.eyJ[A-Za-z0-9_-]+\\.[A-Za-z0-9_-]+"),
)
RULES = BASE + MORE


# ---- from expressions to trigram queries


def _fold(s: str) -> str:
    return "".join(c.lower() if c.isascii() else c for c in s)


def _grams(s: str) -> frozenset[str]:
    return frozenset(s[i : i + 3] for i in range(len(s) - 2))


def _both(a: Query, b: Query) -> Query:
    out = {x | y for x in a for y in b}
    return _least(out) if len(out) <= MOST else (a if a != ALWAYS else b)


def _least(clauses) -> Query:
    """Without clauses that another one implies."""
    clauses = set(clauses)
    kept = frozenset(c for c in clauses if not any(o < c for o in clauses))
    return ALWAYS if frozenset() in kept or len(kept) > MOST else kept


def _of_literals(words) -> Query:
    """What holds for a text with one of these words."""
    return _least(_grams(w) for w in words)


def _walk(items) -> tuple[set[str] | None, Query]:
    """(all strings that the items match, if they are few, else None; a query that every match satisfies)."""
    run: set[str] | None = {""}
    exact = True
    query = ALWAYS
    for op, arg in items:
        words, own = _item(op, arg)
        if words is not None and len(run) * len(words) <= MOST:
            run = {a + b for a in run for b in words}
            continue
        query = _both(query, _of_literals(run))
        exact = False
        if words is None:
            query, run = _both(query, own), {""}
        else:
            run = set(words)
    return (run if exact else None), (ALWAYS if exact else _both(query, _of_literals(run)))


def _item(op, arg) -> tuple[set[str] | None, Query]:
    if op is sre.LITERAL:
        return {_fold(chr(arg))}, ALWAYS
    if op is sre.IN:
        if all(k is sre.LITERAL for k, _ in arg):
            chars = {_fold(chr(v)) for _, v in arg}
            if len(chars) <= 4:
                return chars, ALWAYS
        return None, ALWAYS
    if op is sre.SUBPATTERN:
        return _walk(arg[-1])
    if op is sre.BRANCH:
        parts = [_walk(x) for x in arg[1]]
        if all(w is not None for w, _ in parts) and sum(len(w) for w, _ in parts) <= MOST:
            return set().union(*(w for w, _ in parts)), ALWAYS
        return None, _least(c for w, q in parts for c in (q if w is None else _of_literals(w)))
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, inner = arg
        words, query = _walk(inner)
        if words is not None and high == 1:
            return words | ({""} if low == 0 else set()), ALWAYS
        if words is not None and low == high and len(words) == 1:
            return {w * low for w in words}, ALWAYS
        if low == 0:
            return None, ALWAYS
        return None, query if words is None else _of_literals(words)
    return None, ALWAYS


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query of an expression; ALWAYS if it forces none. Trigrams are in lower case (ASCII)."""
    words, query = _walk(_parser.parse(pattern))
    return _of_literals(words) if words is not None else query


def holds(query: Query, text: str) -> bool:
    low = _fold(text)
    return any(all(g in low for g in clause) for clause in query)


# ---- the index


def build_index(docs: DataFrame, trigrams: list[str], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Postings (trigram, key), one for each listed trigram and row that holds it; the vocabulary is that of the rules' queries,
    so that an index stays far below the size of the texts."""
    low = F.lower(F.col(text))
    found = [F.when(F.contains(F.col("_low"), F.lit(g)), F.lit(g)) for g in sorted(trigrams)]
    slim = docs.select(F.col(key).alias(key), low.alias("_low"))
    return slim.select(key, F.explode(F.filter(F.array(*found), lambda g: g.isNotNull())).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...], key: str = "doc_id") -> DataFrame:
    """(key, rules: array of kinds) by intersecting postings: a clause holds where all its trigrams have a posting of the key."""
    clauses = [(r.kind, sorted(c)) for r in rules for c in sorted(trigram_query(r.pattern), key=sorted) if c]
    have = index.groupBy(key).agg(F.collect_set("trigram").alias("_have"))
    kinds: dict[str, list[Column]] = {}
    for kind, grams in clauses:
        need = F.array(*map(F.lit, grams))
        kinds.setdefault(kind, []).append(F.size(F.array_intersect(F.col("_have"), need)) == len(grams))
    if not kinds:
        return index.select(key, F.array().cast("array<string>").alias("rules")).limit(0)
    hits = []
    for kind, any_of in kinds.items():
        ok = any_of[0]
        for other in any_of[1:]:
            ok = ok | other
        hits.append(F.when(ok, F.lit(kind)))
    out = have.select(key, F.filter(F.array(*hits), lambda k: k.isNotNull()).alias("rules"))
    return out.where(F.size("rules") > 0)


# ---- verification

SPAN = "struct<start:int,kind_no:int,end:int,kind:string>"


def _single_run(rule: Rule) -> str:
    """For the verification of a plain run such as [0-9a-f]+ the least length moves into the expression: a maximal run is kept
    or dropped as a whole, so the matches are the same, and short runs cost nothing."""
    parsed = list(_parser.parse(rule.pattern))
    if rule.group == 0 and len(parsed) == 1 and parsed[0][0] is sre.MAX_REPEAT and rule.pattern.endswith("]+"):
        return f"{rule.pattern[:-1]}{{{rule.least},}}"
    return rule.pattern


def _matches(text: Column, rule: Rule) -> Column:
    """array<struct<gap, size, ok>>: of each leftmost match, the code points before it and its own; ok: its group is long enough."""
    p = F.lit(_single_run(rule))
    whole = F.regexp_extract_all(text, p, F.lit(0))
    part = F.regexp_extract_all(text, p, F.lit(rule.group)) if rule.group else whole
    return F.zip_with(
        F.arrays_zip(whole.alias("w"), part.alias("g")),
        F.slice(F.split(text, _single_run(rule), -1), 1, F.size(whole)),
        lambda m, gap: F.struct(F.length(gap).alias("gap"), F.length(m["w"]).alias("size"), (F.length(m["g"]) >= rule.least).alias("ok")),
    )


def _running(items: Column, first: Column, kind: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """array<kind>: what `step` makes of each item and of the state that it leaves to the next one.

    An array that grows by one in each step of a fold is copied each time. So items are folded in runs of about the square root of their
    number, and only whole runs are appended to the result: n items cost n to the power 1.5 at most.
    """
    none = F.array().cast(f"array<{kind}>")

    def folded(m: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(m))).cast("int")

        def one(acc, item):
            state, out = step(acc["at"], item)
            return F.struct(state.alias("at"), F.concat(acc["out"], F.array(out.cast(kind))).alias("out"))

        def run(acc, n):
            begin = F.struct(acc["at"].alias("at"), none.alias("out"))
            return F.aggregate(F.slice(m, n * width + 1, width), begin, one, lambda r: F.struct(r["at"].alias("at"), F.concat(acc["out"], r["out"]).alias("out")))

        begin = F.struct(first.alias("at"), none.alias("out"))
        return F.when(F.size(m) > 0, F.aggregate(F.sequence(F.lit(0), F.floor((F.size(m) - 1) / F.greatest(width, F.lit(1))).cast("int")), begin, run, lambda acc: acc["out"])).otherwise(none)

    return _bound(F.transform(items, lambda x: x), folded)  # as objects, of which a slice takes no copies


def _bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), where value is worked out once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """array<struct<start, kind_no, end, kind>> of the matches that count; end exclusive, in code points."""

    def step(at, m):
        start, end = at + m["gap"], at + m["gap"] + m["size"]
        return end, F.struct(start.alias("start"), F.lit(order).alias("kind_no"), end.alias("end"), F.when(m["ok"], F.lit(rule.kind)).alias("kind"))

    return F.filter(_running(_matches(text, rule), F.lit(0), SPAN, step), lambda s: s["kind"].isNotNull())


#: Most bytes of candidates that are broadcast, and what a candidate takes besides its key.
BROADCAST_BYTES, ROW_BYTES = 32_000_000, 100


def find(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(_row: the row as a struct, _text, _spans: array<struct<start, kind_no, end, kind>> by start, then by the rules' order).

    Texts are read twice: once for the index, once for verification, where they meet the candidates by key. Candidates are written first and
    their size is known: up to BROADCAST_BYTES they go to every task and texts stay where they are, beyond that both meet by a shuffle.
    """
    indexed = [r for r in rules if trigram_query(r.pattern) != ALWAYS]
    grams = sorted({g for r in indexed for c in trigram_query(r.pattern) for g in c})
    rows = boxed(docs, _key=F.col(key), _text=F.col(text))
    if grams:
        found = settle(candidates(build_index(rows, grams, "_key", "_text"), tuple(indexed), "_key").select(F.col("_key").alias("_hit"), F.col("rules").alias("_rules")), "candidates")
        size = found.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(F.col("_hit").cast("string"))), F.lit(0)).alias("b")).first()
        found = F.broadcast(found) if size["b"] + ROW_BYTES * size["n"] <= BROADCAST_BYTES else found
        rows = rows.join(found, F.col("_key").eqNullSafe(F.col("_hit")), "left")
    else:
        rows = rows.withColumn("_rules", F.array().cast("array<string>"))
    body = F.coalesce("_text", F.lit(""))
    none = F.array().cast(f"array<{SPAN}>")
    parts = []
    for i, r in enumerate(rules):
        on = F.array_contains("_rules", r.kind) if r in indexed else body.rlike(_single_run(r))
        parts.append(F.when(on, _spans(body, r, i)).otherwise(none))
    return rows.select("_row", "_key", "_text", F.array_sort(F.concat(*parts)).alias("_spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_<kind> for the base kinds, base_sha256 and spans."""
    base = F.filter("_spans", lambda s: s["kind_no"] < len(BASE))
    of_kind = lambda kind: F.filter("_spans", lambda s: s["kind"] == kind)
    counts = [F.size(of_kind(r.kind)).cast("long").alias(f"n_{r.kind}") for r in BASE]
    found = find(docs.select(key, text), rules, key, text).select("_key", "_spans")
    return found.select(F.col("_key").alias(key), *counts, F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"), _joined(F.col("_spans")).alias("spans"))


#: Code points of the chunks that a text is cut into before parts of it are taken.
CHUNK = 4096


def _part(chunks: Column, start: Column, end: Column) -> Column:
    """Code points start to end (exclusive) of the text that was cut into chunks: what it costs does not depend on where they lie."""
    first, last = F.floor(start / CHUNK).cast("int"), F.floor((end - 1) / CHUNK).cast("int")

    def own(c):
        begin = F.greatest(start - c * CHUNK, F.lit(0))
        return F.substring(F.get(chunks, c), begin + 1, F.least(end - c * CHUNK, F.lit(CHUNK)) - begin)

    return F.when(end > start, F.array_join(F.transform(F.sequence(first, last), own), "")).otherwise("")


def _redacted(text: Column, spans: Column) -> Column:
    """The text with each span, or run of overlapping spans, replaced by [kind] of its first."""

    def step(at, s):
        return F.greatest(at, s["end"]), F.struct(at.alias("start"), F.lit(0).alias("kind_no"), s["start"].alias("end"), F.when(s["start"] >= at, s["kind"]).alias("kind"))

    def cut(both):
        chunks, gaps = both["chunks"], both["gaps"]
        marked = F.transform(F.filter(gaps, lambda g: g["kind"].isNotNull()), lambda g: F.concat(_part(chunks, g["start"], g["end"]), F.lit("["), g["kind"], F.lit("]")))
        return F.concat(F.array_join(marked, ""), _part(chunks, both["rest"], both["size"]))

    last = F.aggregate(spans, F.lit(0), lambda at, s: F.greatest(at, s["end"]))
    return _bound(F.struct(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)).alias("chunks"), _running(spans, F.lit(0), SPAN, step).alias("gaps"), last.alias("rest"), F.length(text).alias("size")), cut)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, key: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """docs with every found span replaced by [kind]; spans that overlap become one. Texts without a secret, and nulls, stay as they are."""
    own = F.col("_text")
    clean = _redacted(own, F.col("_spans"))
    out = find(docs, rules, key, text).withColumn("_clean", F.when(F.size("_spans") > 0, clean).otherwise(own))
    columns = []
    for c in docs.columns:
        old = F.col("_row").getField(c)
        if c == text:
            old = F.col("_clean")
        elif c == length:
            old = F.when(F.size("_spans") > 0, F.length("_clean")).otherwise(old).cast(docs.schema[c].dataType)
        columns.append(old.alias(c))
    return out.select(*columns)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


def _sql() -> str:
    def one(i: int, r: Rule) -> str:
        p = r.pattern.replace("'", "''")
        g = f"regexp_extract_all(t, '{p}', {r.group})"
        return f"""select rid, {i} as kind_no, '{r.kind}' as kind, unnest(range(1, len(w) + 1)) as i, w, g, s from (
            select rid, regexp_extract_all(t, '{p}') as w, {g} as g, string_split_regex(t, '{p}') as s from d where regexp_matches(t, '{_single_run(r).replace("'", "''")}'))"""

    parts = " union all ".join(f"({one(i, r)})" for i, r in enumerate(RULES))
    least = " ".join(f"when {i} then {r.least}" for i, r in enumerate(RULES))
    counts = ", ".join(f"count(start) filter (where kind = '{r.kind}') as n_{r.kind}" for r in BASE)
    joined = lambda where: f"coalesce(string_agg(kind || ':' || start || ':' || stop, ',' order by start, kind_no){where}, '')"
    return f"""with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as t from documents),
    m as ({parts}),
    p as (select rid, kind_no, kind, length(w[i]) as size, g[i] as part,
            sum(length(s[i])) over (partition by rid, kind_no order by i) + sum(length(w[i])) over (partition by rid, kind_no order by i) as stop from m),
    k as (select rid, kind_no, kind, cast(stop - size as bigint) as start, cast(stop as bigint) as stop from p where length(part) >= case kind_no {least} end)
    select any_value(d.doc_id) as doc_id, {counts}, sha256({joined(f" filter (where kind_no < {len(BASE)})")}) as base_sha256, {joined("")} as spans
    from d left join k using (rid) group by d.rid"""


SQL = {"op3_secret_scan": _sql()}
QUERIES = {"op3_secret_scan": op3_secret_scan}
