"""Secret scans: three patterns, and the entropy of sliding windows over candidate strings.

Spark's regular expressions return matches without places, so the places come from the lengths of the gaps and matches before, summed up block
by block.  All of it stays inside the row.  What the allow-list knows is blanked out before candidates are looked for, so it takes only
itself away and never the secret beside it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm import common

# The base patterns.  A match of the last two is a whole run of its characters, so a run that is too short can be left out at once.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_MIN = 6
KINDS = ("assign", "access", "hex", "entropy")

#: Runs of token characters that are long enough for a window.
WINDOW = 20
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
#: Bits per character that a window needs, by character class: hexadecimal digits, and all token characters.
MIN_BITS = {"hex": 3.0, "token": 3.9}
#: No part of a secret: placeholders and counting sequences.
ALLOWED = "(?i:example|sample|dummy|placeholder|xxxx|abcdefgh|01234567|12345678)"
#: No secret as a whole: identifiers.
IDENTIFIER = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
#: The characters of candidates; their counts are kept in fields of a few bits, several to a number.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
FIELD, FIELDS = 5, 12
#: Matches whose places are summed up at once.
BLOCK = 256

_SPANS = "array<struct<start:int,kind:int,end:int>>"
#: n * log2(n) in millionths, so that sums are exact.
N_LOG_N = [0] + [round(n * math.log2(n) * 1e6) for n in range(1, WINDOW + 1)]
#: Entropy >= bits means that the sum of n * log2(n) over the window's characters is at most this.
MOST = {name: math.floor((math.log2(WINDOW) - bits) * WINDOW * 1e6) for name, bits in MIN_BITS.items()}


def _matches(text: Column, pattern: str, use) -> Column:
    """``use(match, start)`` of every match in text order, an array of spans each; empty if the pattern is nowhere."""
    def lengths(found: Column) -> Column:
        sizes = F.zip_with(F.slice(found["gaps"], F.lit(1), F.size(found["hits"])), found["hits"],
                           lambda g, h: F.struct(F.length(g).alias("gap"), F.length(h).alias("hit")))
        return common.bind(sizes, lambda s: F.flatten(F.zip_with(found["hits"], _starts(s), use)))
    parts = F.struct(F.split(text, pattern, -1).alias("gaps"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"))
    return F.when(text.rlike(pattern), common.bind(parts, lengths)).otherwise(F.array().cast(_SPANS))


def _starts(sizes: Column) -> Column:
    """Places of matches from (gap, hit) lengths: first of every block, then inside the blocks, so that no long list grows by appending."""
    blocks = F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / BLOCK).cast("int"))

    def block(b: Column) -> Column:
        return F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK))

    def inside(begin: Column, b: Column) -> Column:
        start = F.struct(begin.alias("at"), F.array().cast("array<int>").alias("out"))
        return F.aggregate(block(b), start, lambda acc, x: F.struct(
            (acc["at"] + x["gap"] + x["hit"]).alias("at"), F.concat(acc["out"], F.array(acc["at"] + x["gap"])).alias("out")))["out"]
    totals = F.transform(blocks, lambda b: F.aggregate(block(b), F.lit(0), lambda n, x: n + x["gap"] + x["hit"]))
    begins = F.aggregate(totals, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    return common.bind(begins, lambda at: F.flatten(F.transform(blocks, lambda b: inside(F.element_at(at, b + 1), b))))


def blanked(text: Column) -> Column:
    """The text with blanks in place of what the allow-list knows."""
    parts = F.zip_with(F.split(text, ALLOWED, -1), F.regexp_extract_all(text, F.lit(ALLOWED), F.lit(0)),
                       lambda gap, hit: F.concat(gap, F.repeat(F.lit(" "), F.coalesce(F.length(hit), F.lit(0)))))
    return F.when(text.rlike(ALLOWED), F.array_join(parts, "")).otherwise(text)


def _span(kind: str, start: Column, end: Column) -> Column:
    return F.array(F.struct(start.cast("int").alias("start"), F.lit(KINDS.index(kind)).alias("kind"), end.cast("int").alias("end")))


def _if(test: Column, span: Column) -> Column:
    return F.when(test, span).otherwise(F.array().cast(_SPANS))


def _whole_match(kind: str):
    return lambda hit, start: _span(kind, start, start + F.length(hit))


def _assignment(hit: Column, start: Column) -> Column:
    long_enough = F.length(F.regexp_extract(hit, ASSIGN, 1)) >= ASSIGN_MIN
    return _if(long_enough, _span("assign", start, start + F.length(hit)))


def _entropic(hit: Column, start: Column) -> Column:
    """From the first to the last window whose entropy reaches the bound of its class.  A table of counts and the sum of n * log2(n) over it change
    by the character that enters and the one that leaves."""
    terms = F.array(*[F.lit(v).cast("bigint") for v in N_LOG_N])
    units = F.array(*[F.lit(1 << FIELD * i).cast("bigint") for i in range(FIELDS)])
    most = F.when(hit.rlike(r"^[0-9a-fA-F]+$"), F.lit(MOST["hex"])).otherwise(F.lit(MOST["token"])).cast("bigint")

    def term(n: Column) -> Column:
        return F.element_at(terms, n + 1)

    def number(code: Column) -> Column:
        return F.floor(code / FIELDS).cast("int")

    def unit(code: Column) -> Column:
        return F.element_at(units, code % FIELDS + 1)

    def count(table: Column, code: Column) -> Column:
        held = F.element_at(table, number(code) + 1)
        return F.call_function("div", held, unit(code)).bitwiseAND(F.lit((1 << FIELD) - 1)).cast("int")

    def windows(v: Column) -> Column:
        codes = v["codes"]

        def step(acc: Column, i: Column) -> Column:
            come, gone = F.element_at(codes, i), F.when(i > WINDOW, F.element_at(codes, F.greatest(i - WINDOW, F.lit(1)))).otherwise(-1)
            return F.element_at(F.transform(F.array(F.struct(come.alias("come"), gone.alias("gone"))), lambda c: changed(acc, i, c["come"], c["gone"])), 1)

        def changed(acc: Column, i: Column, come: Column, gone: Column) -> Column:
            n, m = count(acc["table"], come), count(acc["table"], gone)
            entered, left = term(n + 1) - term(n), F.when(gone < 0, F.lit(0).cast("bigint")).otherwise(term(m - 1) - term(m))
            same = come == gone
            total = acc["total"] + F.when(same, F.lit(0).cast("bigint")).otherwise(entered + left)
            table = F.when(same, acc["table"]).otherwise(F.transform(acc["table"], lambda x, j: x + F.when(j == number(come), unit(come)).otherwise(0)
                                                                     - F.when(j == number(gone), unit(gone)).otherwise(0)))
            return common.bind(total, lambda t: F.struct(
                t.alias("total"), F.when((i >= WINDOW) & (t <= v["most"]) & (acc["first"] < 0), i - WINDOW).otherwise(acc["first"]).alias("first"),
                F.when((i >= WINDOW) & (t <= v["most"]), i - WINDOW).otherwise(acc["last"]).alias("last"), table.alias("table")))
        zero = F.lit(0).cast("bigint")
        empty = F.array_repeat(zero, -(-len(ALPHABET) // FIELDS))
        begin = F.struct(zero.alias("total"), F.lit(-1).alias("first"), F.lit(-1).alias("last"), empty.alias("table"))
        return F.aggregate(F.sequence(F.lit(1), F.size(codes)), begin, step)
    codes = F.transform(F.split(hit, ""), lambda c: F.position(c, F.lit(ALPHABET)) - 1)
    ends = common.bind(F.struct(codes.alias("codes"), most.alias("most")), windows)
    plausible = hit.rlike("[0-9]") & hit.rlike("[A-Za-z]") & ~hit.rlike(IDENTIFIER)
    found = common.bind(ends, lambda e: _if(e["first"] >= 0, _span("entropy", start + e["first"], start + e["last"] + WINDOW)))
    return F.when(plausible, found).otherwise(F.array().cast(_SPANS))


def scanned(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with ``base`` and ``found``: arrays of (start, kind, end) by start, then kind; ``kind`` indexes ``KINDS``.

    Places count code points, ends are exclusive, and an assignment's span is its whole match.  Null texts hold nothing; rows are scanned one by
    one, so repeated rows get the same spans; an empty table gives no rows; input columns named like a result are replaced.
    """
    keep = common.fresh(docs, "base", "found")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), common.whole(F.col("text")).alias("__text"))
    text = F.col("__text")
    base = F.concat(_matches(text, ASSIGN, _assignment), _matches(text, ACCESS, _whole_match("access")),
                    _matches(text, HEX, _whole_match("hex")))
    more = F.when(text.rlike(CANDIDATE), common.bind(blanked(text), lambda t: _matches(t, CANDIDATE, _entropic))).otherwise(F.array().cast(_SPANS))
    rows = rows.select("row", F.sort_array(base).alias("base"), more.alias("__more"))
    return rows.select("row.*", "base", F.sort_array(F.concat("base", "__more")).alias("found"))


def spelled(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def query(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")

    def n(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")
    return scanned(docs).select("doc_id", n("assign"), n("access"), n("hex"),
                                F.sha2(F.encode(spelled(F.col("base")), "UTF-8"), 256).alias("base_sha256"), spelled(F.col("found")).alias("spans"))


def _sql_runs(kind: str, pattern: str, keep: str, table: str = "docs") -> str:
    return f"""
    SELECT rid, '{kind}' AS kind, {KINDS.index(kind)} AS k, CAST(start AS BIGINT) AS start, hit FROM (
        SELECT rid, hit, sum(len(gap)) OVER w + coalesce(sum(len(hit)) OVER (PARTITION BY rid ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
        FROM (SELECT rid, unnest(range(len(hits))) AS i, unnest(hits) AS hit, unnest(gaps[:len(hits)]) AS gap
              FROM (SELECT rid, regexp_extract_all(text, {pattern}) AS hits, string_split_regex(text, {pattern}) AS gaps FROM {table}
                    WHERE regexp_matches(text, {pattern})))
        WINDOW w AS (PARTITION BY rid ORDER BY i))
    WHERE {keep}"""


_ASSIGN_SQL = "'" + ASSIGN.replace("'", "''") + "'"
SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
assign AS ({_sql_runs("assign", _ASSIGN_SQL, f"len(regexp_extract(hit, {_ASSIGN_SQL}, 1)) >= {ASSIGN_MIN}")}),
access AS ({_sql_runs("access", "'AKIA[A-Z0-9]+'", "len(hit) >= 20")}),
hexes AS ({_sql_runs("hex", "'[0-9a-f]+'", "len(hit) >= 24")}),
blanked AS (
    SELECT rid, CASE WHEN regexp_matches(text, '{ALLOWED}') THEN array_to_string(list_transform(
        list_zip(string_split_regex(text, '{ALLOWED}'), regexp_extract_all(text, '{ALLOWED}')), lambda z: z[1] || repeat(' ', coalesce(len(z[2]), 0))), '') ELSE text END AS text FROM docs),
candidates AS ({_sql_runs("entropy", "'" + CANDIDATE + "'", f"regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]') AND NOT regexp_matches(hit, '{IDENTIFIER}')", "blanked")}),
windows AS (
    SELECT rid, start, hit, i, list_sum(list_transform(map_values(list_histogram(string_split(substr(hit, i + 1, {WINDOW}), ''))),
                                                       lambda n: [{", ".join(map(str, N_LOG_N[1:]))}][CAST(n AS BIGINT)])) AS total
    FROM (SELECT *, unnest(range(len(hit) - {WINDOW - 1})) AS i FROM candidates)),
entropy AS (
    SELECT rid, 'entropy' AS kind, {KINDS.index("entropy")} AS k, start + min(i) AS start, start + max(i) + {WINDOW} AS stop FROM windows
    WHERE total <= CASE WHEN regexp_matches(hit, '^[0-9a-fA-F]+$') THEN {MOST["hex"]} ELSE {MOST["token"]} END GROUP BY rid, start, hit),
base AS (
    SELECT rid, kind, k, start, start + len(hit) AS stop FROM (FROM assign UNION ALL FROM access UNION ALL FROM hexes)),
found AS (FROM base UNION ALL SELECT rid, kind, k, start, stop FROM entropy),
spelled AS (
    SELECT rid, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
           coalesce(string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) FILTER (k < 3), '') AS base,
           string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans
    FROM found GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN spelled USING (rid)
"""
