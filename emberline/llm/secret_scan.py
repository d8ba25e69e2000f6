"""Secret scans over a trigram inverted index.

From each rule's expression a Boolean query over trigrams is derived: clauses of
trigrams that every match must contain. Documents are posted under the trigrams
that any rule asks for; the postings of a clause are intersected by counting, and
only documents that pass are searched with the expression itself. A rule without
a mandatory trigram searches every text. Everything runs as DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product
from re import _parser

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emberline.session import scratch_path

_ANY_CASE_KEY = "".join(f"[{c.upper()}{c}]" for c in "api") + "_?" + "".join(f"[{c.upper()}{c}]" for c in "key")


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    """An expression (no look-around, no back-references) and the least length of its match.

    Where there is a ``lead``, the length is that of what follows it.
    """

    kind: str
    pattern: str
    least: int = 1
    lead: str = ""


_LEAD = ("(?:" + "|".join(map(_any_case, ("password", "passwd", "secret", "token"))) + "|" + _ANY_CASE_KEY
         + r")[\"']?\x20*[:=]\x20*[\"']?")
#: The three base kinds first; their order is that of spans with the same start.
BASE = (
    Rule("assign", _LEAD + "[A-Za-z0-9+/_.=-]+", 6, _LEAD),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    # runs are maximal: the same as all runs less the short ones
    Rule("hex", "[0-9a-f]{24,}", 24),
)
RULES = (
    *BASE,
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]+", 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30),
    Rule("url_login", r"[a-z][a-z0-9+.-]*://[^\x00-\x20/:@]+:[^\x00-\x20/@]+@"),
)

# ------------------------------------------------------------------ trigram queries

_MOST_STRINGS = 64


@dataclass
class _Part:
    """What is known of a sub-expression: all strings it can be (None: too many), and a query."""

    strings: frozenset[str] | None
    clauses: frozenset[frozenset[str]]


_TRUE = frozenset([frozenset()])


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _either(strings: frozenset[str]) -> frozenset[frozenset[str]]:
    """A clause per possible string; one without trigrams makes the query true."""
    clauses = frozenset(map(_trigrams, strings))
    return _TRUE if frozenset() in clauses else frozenset(
        c for c in clauses if not any(other < c for other in clauses))


def _both(left: frozenset, right: frozenset) -> frozenset:
    return frozenset(a | b for a, b in product(left, right)) if len(left) * len(right) <= _MOST_STRINGS else left


def _sequence(items) -> _Part:
    """Runs of sub-expressions with known strings are multiplied out before trigrams are taken."""
    query, known, whole = _TRUE, frozenset([""]), True
    for item in items:
        part = _part(item)
        if part.strings is not None and len(known) * len(part.strings) <= _MOST_STRINGS:
            known = frozenset(a + b for a, b in product(known, part.strings))
            continue
        query, whole = _both(query, _either(known)), False
        known = frozenset([""])
        if part.strings is not None:
            known = part.strings
        else:
            query = _both(query, part.clauses)
    if whole:
        return _Part(known, _either(known))
    return _Part(None, _both(query, _either(known)))


def _part(item) -> _Part:
    code, value = str(item[0]), item[1]
    if code == "LITERAL":
        return _one(chr(value).lower())
    if code == "IN":
        letters = set()
        for kind, span in value:
            if str(kind) == "LITERAL":
                letters.add(chr(span).lower())
            elif str(kind) == "RANGE" and span[1] - span[0] < _MOST_STRINGS:
                letters.update(chr(c).lower() for c in range(span[0], span[1] + 1))
            else:
                return _Part(None, _TRUE)
        return _Part(frozenset(letters), _TRUE) if len(letters) <= 8 else _Part(None, _TRUE)
    if code == "SUBPATTERN":
        return _sequence(value[3])
    if code == "BRANCH":
        parts = [_sequence(branch) for branch in value[1]]
        if all(part.strings is not None for part in parts):
            strings = frozenset().union(*(part.strings for part in parts))
            return _Part(strings, _either(strings))
        return _Part(None, frozenset().union(*(part.clauses for part in parts)))
    if code in ("MAX_REPEAT", "MIN_REPEAT"):
        least, most, inner = value
        part = _sequence(inner)
        if (least, int(most)) == (0, 1) and part.strings is not None:
            return _Part(part.strings | {""}, _TRUE)
        return _Part(None, part.clauses if least else _TRUE)
    return _Part(None, _TRUE)


def _one(text: str) -> _Part:
    return _Part(frozenset([text]), _TRUE)


def trigram_query(pattern: str) -> list[list[str]]:
    """Clauses of lower-case trigrams; a match contains all of at least one. Empty: no mandatory ones."""
    clauses = _sequence(_parser.parse(pattern)).clauses
    clauses = [c for c in clauses if not any(other < c for other in clauses)]
    return [] if any(not c for c in clauses) else sorted(sorted(c) for c in clauses)


# ------------------------------------------------------------------ index and search

#: What a row is known by between the steps; rows equal in both have equal texts.
_ROW = ["_id", "_hash"]


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.coalesce("doc_id", F.lit(0)).alias("_id"), F.xxhash64("doc_id", text).alias("_hash"),
                       F.col("doc_id"), text.alias("text"))


def postings(texts: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """(row, trigram) for the trigrams asked for, over lower-cased texts."""
    folded = F.lower("text")
    found = F.filter(F.array(*[F.lit(t) for t in trigrams]), lambda t: F.contains(folded, t))
    return texts.select(*_ROW, F.explode(found).alias("trigram")).distinct()


def candidates(posted: DataFrame, queries: dict[str, list[list[str]]]) -> DataFrame:
    """(row, kinds): the rules of which some clause has all its trigrams posted for the row."""
    clauses = [(kind, number, trigram, len(clause)) for kind, query in queries.items()
               for number, clause in enumerate(query) for trigram in clause]
    # as many rows as the rules' queries have trigrams; as Arrow, since a list of rows would start Python workers
    names, kinds = ("kind", "clause", "trigram", "wanted"), (pa.string(), pa.int32(), pa.string(), pa.int32())
    asked = posted.sparkSession.createDataFrame(pa.table(
        {name: pa.array([c[i] for c in clauses], kind) for i, (name, kind) in enumerate(zip(names, kinds))}))
    met = (posted.join(F.broadcast(asked), "trigram").groupBy(*_ROW, "kind", "clause")
           .agg(F.count(F.lit(1)).alias("found"), F.first("wanted").alias("wanted")).filter("found = wanted"))
    return met.groupBy(*_ROW).agg(F.collect_set("kind").alias("kinds"))


def _matches(rule: Rule) -> Column:
    """gap before, length, and whether long enough, of each match: leftmost, non-overlapping."""
    found = F.regexp_extract_all(F.col("text"), F.lit(rule.pattern), F.lit(0))
    gaps = F.slice(F.split(F.col("text"), rule.pattern, -1), F.lit(1), F.size(found))

    def one(match: Column, gap: Column) -> Column:
        value = F.regexp_replace(match, "^" + rule.lead, "") if rule.lead else match
        return F.struct(F.length(gap).alias("gap"), F.length(match).alias("length"),
                        (F.length(value) >= rule.least).alias("good"))

    return F.struct(F.lit(rule.kind).alias("kind"), F.zip_with(found, gaps, one).alias("matches"))


def spans(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(row, kind, place of the kind in ``rules``, from, to) of every secret; code points, end exclusive."""
    texts = _keyed(docs)
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    found = None
    for rule in rules:
        if not queries[rule.kind]:
            whole = texts.filter(F.col("text").rlike(rule.pattern)).select(*_ROW, _matches(rule).alias("one"))
            found = whole if found is None else found.union(whole)
    asked = {kind: query for kind, query in queries.items() if query}
    if asked:
        spark, path = docs.sparkSession, scratch_path(docs.sparkSession, "candidates")
        trigrams = sorted({t for query in asked.values() for clause in query for t in clause})
        candidates(postings(texts, trigrams), asked).write.parquet(path)
        # stored, so that its size is known when the join is planned
        verified = texts.join(spark.read.parquet(path), _ROW).select(*_ROW, F.explode(F.filter(F.array(*[
            F.when(F.array_contains("kinds", rule.kind), _matches(rule)) for rule in rules if rule.kind in asked]),
            F.isnotnull)).alias("one"))
        found = verified if found is None else found.union(verified)
    # equal rows have equal matches: one of each
    each = (found.select(*_ROW, "one.kind", "one.matches").filter(F.size("matches") > 0)
            .groupBy(*_ROW, "kind").agg(F.first("matches").alias("matches"))
            .select(*_ROW, "kind", F.posexplode("matches").alias("_at", "_m")))
    before = Window.partitionBy(*_ROW, "kind").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("_m.gap").cast("bigint") + F.col("_m.length")).over(before)
    order = F.array_position(F.array(*[F.lit(rule.kind) for rule in rules]), F.col("kind")).alias("order")
    return (each.withColumn("to", end).filter("_m.good")
            .select(*_ROW, "kind", order, (F.col("to") - F.col("_m.length")).alias("from"), "to"))


def _joined(parts: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(parts), lambda s: s["label"]), ",")


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per row of ``docs``: doc_id, one count n_<kind> per rule, base_sha256 and spans.

    Spans read kind:start:end, by start and then by the order of the rules, and the digest is of
    those of the base kinds alone. Null and empty texts have none, rows that repeat give the same
    each time, a null doc_id is a row as any other, and an empty table gives no rows.
    """
    label = F.concat_ws(":", "kind", "from", "to").alias("label")
    base = F.col("kind").isin([rule.kind for rule in BASE])
    item = F.struct("from", "order", label)
    per_row = spans(docs, rules).groupBy(*_ROW).agg(
        *[F.count_if(F.col("kind") == rule.kind).alias(f"n_{rule.kind}") for rule in rules],
        _joined(F.collect_list(F.when(base, item))).alias("_base"), _joined(F.collect_list(item)).alias("spans"))
    counts = [F.coalesce(f"n_{rule.kind}", F.lit(0)).cast("bigint").alias(f"n_{rule.kind}") for rule in rules]
    return _keyed(docs).select(*_ROW, "doc_id").join(per_row, _ROW, "left").select(
        "doc_id", *counts, F.sha2(F.coalesce("_base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"))


def redact(docs: DataFrame, mark: str = "[SECRET]", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``docs`` with every secret replaced by ``mark``, and n_chars (if there) counted anew.

    Overlapping secrets are replaced as one. Texts without any stay as they are, null too.
    """
    by_row = Window.partitionBy(*_ROW).orderBy("from", "to")
    reach = F.max("to").over(by_row.rowsBetween(Window.unboundedPreceding, -1))
    merged = (spans(docs, rules).withColumn("_new", F.coalesce(F.col("from") >= reach, F.lit(True)).cast("int"))
              .withColumn("_part", F.sum("_new").over(by_row.rowsBetween(Window.unboundedPreceding, 0)))
              .groupBy(*_ROW, "_part").agg(F.min("from").alias("from"), F.max("to").alias("to"))
              .groupBy(*_ROW).agg(F.array_sort(F.collect_list(F.struct("from", "to"))).alias("_cuts")))
    path = scratch_path(docs.sparkSession, "cuts")
    merged.write.parquet(path)
    text = F.col("_doc.text")
    # the row travels as one struct, so that no column of it can clash
    keyed = docs.select(F.struct("*").alias("_doc"), F.coalesce("doc_id", F.lit(0)).alias("_id"),
                        F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("_hash"))
    joined = keyed.join(docs.sparkSession.read.parquet(path), _ROW, "left")

    def end_before(i: Column) -> Column:
        return F.when(i == 0, 0).otherwise(F.get("_cuts", i - 1)["to"])

    between = F.transform("_cuts", lambda cut, i: F.substring(
        text, (end_before(i) + 1).cast("int"), (cut["from"] - end_before(i)).cast("int")))
    tail = F.substring(text, (F.element_at("_cuts", -1)["to"] + 1).cast("int"), F.length(text))
    clean = F.when(F.col("_cuts").isNotNull(), F.array_join(F.concat(between, F.array(tail)), mark)).otherwise(text)
    changed = {"text": clean}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("_cuts").isNotNull(), F.length(clean)).otherwise(
            F.col("_doc.n_chars")).cast(docs.schema["n_chars"].dataType)
    return joined.select(*[changed.get(name, F.col(f"_doc.`{name}`")).alias(name) for name in docs.columns])


def scan_sql(rules: Sequence[Rule] = RULES) -> str:
    """The same in DuckDB's SQL, over a table ``documents``."""
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    each = " UNION ALL ".join(
        f"SELECT r, '{rule.kind}' AS kind, {number} AS ord, {rule.least} AS least, {quoted('^' + rule.lead)} AS lead, "
        f"regexp_extract_all(t, {quoted(rule.pattern)}) AS m, regexp_split_to_array(t, {quoted(rule.pattern)}) AS g "
        "FROM d" for number, rule in enumerate(rules))
    counts = ", ".join(f"coalesce(n_{rule.kind}, 0) AS n_{rule.kind}" for rule in BASE)
    sums = ", ".join(f"count(*) FILTER (kind = '{rule.kind}') AS n_{rule.kind}" for rule in BASE)
    kinds = ", ".join(f"'{rule.kind}'" for rule in BASE)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({each}),
each_one AS (SELECT r, kind, ord, least, lead, unnest(m) AS m, unnest(g[1:len(m)]) AS g,
                    generate_subscripts(m, 1) AS i FROM found),
placed AS (SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY r, kind ORDER BY i) AS e FROM each_one),
good AS (SELECT r, kind, ord, e - length(m) AS b, e FROM placed WHERE length(regexp_replace(m, lead, '')) >= least),
labelled AS (SELECT *, kind || ':' || CAST(b AS BIGINT) || ':' || CAST(e AS BIGINT) AS label FROM good),
per_row AS (SELECT r, {sums}, string_agg(label, ',' ORDER BY b, ord) FILTER (kind IN ({kinds})) AS base,
                   string_agg(label, ',' ORDER BY b, ord) AS spans FROM labelled GROUP BY r)
SELECT doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per_row USING (r)"""
