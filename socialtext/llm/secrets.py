"""Secret scan with a trigram inverted index. DataFrame functions only.

Each rule's regular expression is turned into a Boolean query over trigrams that any match must contain. The index holds
a posting ``(row, trigram)`` for the trigrams that some rule asks for; postings are intersected per alternative, and only
the candidates are read again and verified. A rule without mandatory trigrams (hexadecimal runs) is verified on every row.

Null text counts as empty. Rows are told apart by ``doc_id`` and a hash of the text, so repeated rows give repeated
results; a null ``doc_id`` is a row like any other; other columns are not touched; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _parser as regex_parser

from pyspark.sql import Column, DataFrame, functions as F

from socialtext.llm.tables import probable, stored


@dataclass(frozen=True)
class Rule:
    """``pattern`` as Java and RE2 read it; a match counts when ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base rules, in the order in which equal starts are listed, then those that this operator adds.
BASE = (
    Rule("assign", "(?i)(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),  # a run of 20 and more, key included
    Rule("hex", "[0-9a-f]{24,}"),
)
MORE = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE
#: A class or product with more strings than this is treated as "anything".
_MOST_STRINGS = 64


def _strings(tree) -> list[set[str] | None]:
    """The tree as a sequence of sets of lower-case strings; None stands for anything."""
    out: list[set[str] | None] = []
    for op, arg in tree:
        name = str(op)
        if name == "LITERAL":
            out.append({chr(arg).lower()})
        elif name == "IN":
            found: set[str] | None = set()
            for kind, value in arg:
                if str(kind) == "LITERAL" and found is not None:
                    found.add(chr(value).lower())
                elif str(kind) == "RANGE" and found is not None and value[1] - value[0] < 8:
                    found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
                else:
                    found = None
            out.append(found if found and len(found) <= 8 else None)
        elif name == "SUBPATTERN":
            out += _strings(arg[3])
        elif name == "BRANCH":
            sides = [_exact(_strings(side)) for side in arg[1]]
            out.append(None if None in sides else set().union(*sides))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, inner = arg
            exact = _exact(_strings(inner))
            if exact is not None and most == 1 and least == 0:
                out.append({""} | exact)
            elif exact is not None and least == most and len(exact) ** least <= _MOST_STRINGS:
                out += [exact] * least
            else:
                out += [exact if least else None, None] if least else [None]
        elif name != "AT":
            out.append(None)
    return out


def _exact(parts: list[set[str] | None]) -> set[str] | None:
    if any(p is None for p in parts):
        return None
    if not parts:
        return {""}
    found = {"".join(x) for x in product(*parts)}
    return found if len(found) <= _MOST_STRINGS else None


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives, each a set of lower-case trigrams that must all occur; None: every row has to be read.

    Of the fixed stretches of the pattern, the one whose weakest alternative has the most trigrams is asked for.
    """
    runs: list[list[set[str]]] = [[]]
    for part in _strings(regex_parser.parse(pattern)):
        if part is None or _exact([*runs[-1], part]) is None:
            runs.append([])
        if part is not None:
            runs[-1].append(part)
    best: list[frozenset[str]] | None = None
    for run in runs:
        sets = [frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in sorted(_exact(run))]
        if all(sets) and (best is None or min(map(len, sets)) > min(map(len, best))):
            best = sets
    return best


def _rows(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select("doc_id", F.xxhash64(text).alias("_mark"), text.alias("_text"))


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index ``doc_id, _mark, trigram`` over the trigrams that the rules ask for."""
    low = _rows(docs).select("doc_id", "_mark", F.lower("_text").alias("_low"))
    has = F.array_compact(F.array(*[F.when(F.contains("_low", F.lit(t)), F.lit(t)) for t in trigrams]))
    # The outer form: for the inner one Spark pushes a test of the list below it, which looks for all trigrams twice.
    return low.select("doc_id", "_mark", F.explode_outer(has).alias("trigram")).where("trigram is not null")


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``doc_id, _mark, rules``: the rows in which all trigrams of an alternative of a rule occur, by intersecting postings."""
    asked = [(r.kind, n, t, len(sets)) for r in rules for n, sets in enumerate(trigram_query(r.pattern)) for t in sorted(sets)]
    query = index.sparkSession.createDataFrame(asked, "rule string, alternative int, trigram string, wanted int")
    met = (index.join(F.broadcast(query), "trigram").groupBy("doc_id", "_mark", "rule", "alternative", "wanted")
           .agg(F.count_distinct("trigram").alias("got")).where("got = wanted"))
    return met.groupBy("doc_id", "_mark").agg(F.collect_set("rule").alias("rules"))


def spans(text: Column, rule: Rule) -> Column:
    """``kind, start, end`` of the matches in code points, end exclusive, leftmost and without overlap."""
    hits, between = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), F.split(text, rule.pattern, -1)
    empty = F.array().cast("array<struct<start:int,end:int,hit:string>>")

    def step(state, pair):
        start = state["at"] + F.char_length(pair["gap"])
        end = start + F.char_length(pair["hit"])
        found = F.struct(start.alias("start"), end.alias("end"), pair["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(found)).alias("out"))

    pairs = F.zip_with(F.slice(between, 1, F.size(hits)), hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    all_found = F.aggregate(pairs, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda s: s["out"])
    if rule.least:
        all_found = F.filter(all_found, lambda x: F.char_length(F.regexp_extract(x["hit"], rule.pattern, rule.group)) >= rule.least)
    order = [r.kind for r in RULES].index(rule.kind)
    listed = F.transform(all_found, lambda x: F.struct(x["start"].alias("start"), F.lit(order).alias("place"), x["end"].alias("end"), F.lit(rule.kind).alias("kind")))
    nothing = F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")
    return F.when(text.rlike(rule.pattern), listed).otherwise(nothing)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, spans``: for every row its spans as an array of ``start, place, end, kind``, by start and rule order."""
    indexed = tuple(r for r in rules if trigram_query(r.pattern) is not None)
    whole = [r for r in rules if r not in indexed]
    everywhere = _rows(docs).select("doc_id", "_mark", F.concat(*[spans(F.col("_text"), r) for r in whole], F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")).alias("_full"))
    if not indexed:
        return everywhere.select("doc_id", F.array_sort("_full").alias("spans"))
    trigrams = sorted({t for r in indexed for sets in trigram_query(r.pattern) for t in sets})
    chosen = stored(candidates(postings(docs, trigrams), indexed), "secret-candidates")
    text = probable(_rows(docs), chosen, "doc_id")
    same = text["doc_id"].eqNullSafe(chosen["doc_id"]) & (text["_mark"] == chosen["_mark"])
    none = F.array().cast("array<struct<start:int,place:int,end:int,kind:string>>")
    found = F.concat(*[F.when(F.array_contains("rules", r.kind), spans(F.col("_text"), r)).otherwise(none) for r in indexed])
    verified = (text.join(chosen, same).select(text["doc_id"].alias("_id"), text["_mark"].alias("_key"), found.alias("_found"))
                .where(F.size("_found") > 0).dropDuplicates(["_id", "_key"]))
    joined = everywhere.join(verified, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_mark") == F.col("_key")), "left")
    return joined.select("doc_id", F.array_sort(F.concat("_full", F.coalesce("_found", none))).alias("spans"))


def report(docs: DataFrame) -> DataFrame:
    """Counts and digests of the spans of every row of ``documents``."""
    base = [r.kind for r in BASE]

    def listed(array: Column) -> Column:
        return F.array_join(F.transform(array, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scan(docs).select("doc_id", *map(count, base), F.sha2(listed(F.filter("spans", lambda x: x["kind"].isin(*base))), 256).alias("base_sha256"),
                             listed(F.col("spans")).alias("spans"))


def _sql_spans(kind: str, place: int, pattern: str, group: int = 0, least: int = 0) -> str:
    """DuckDB: the spans of one rule as a list of structs."""
    quoted = pattern.replace("'", "''")
    hits, gaps = f"regexp_extract_all(t, '{quoted}')", f"string_split_regex(t, '{quoted}')"
    size = lambda what, upto: f"coalesce(list_sum(list_transform({what}[1:{upto}], lambda y: length(y))), 0)"
    start = f"({size('gaps', 'i')} + {size('hits', 'i - 1')})"
    kept = f"list_filter(range(1, len(hits) + 1), lambda i: length(regexp_extract(hits[i], '{quoted}', {group})) >= {least})"
    return (f"SELECT n, unnest(list_transform({kept}, lambda i: {{'start': {start}, 'place': {place}, "
            f"'stop': {start} + length(hits[i]), 'kind': '{kind}'}})) AS x FROM (SELECT n, {hits} AS hits, {gaps} AS gaps FROM d)")


def oracle() -> str:
    spans_sql = " UNION ALL ".join(_sql_spans(r.kind, i, r.pattern, r.group, r.least) for i, r in enumerate(RULES))
    text = "x.kind || ':' || CAST(CAST(x.start AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(x.stop AS BIGINT) AS VARCHAR)"
    return f"""WITH d AS (SELECT row_number() OVER () AS n, doc_id, coalesce(text, '') AS t FROM documents), s AS ({spans_sql}),
g AS (SELECT n, count(*) FILTER (x.kind = 'assign') AS n_assign, count(*) FILTER (x.kind = 'access') AS n_access,
 count(*) FILTER (x.kind = 'hex') AS n_hex, string_agg({text}, ',' ORDER BY x.start, x.place) FILTER (x.place < {len(BASE)}) AS base,
 string_agg({text}, ',' ORDER BY x.start, x.place) AS spans FROM s GROUP BY n)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
 sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN g USING (n)"""
