"""Secret scans over a trigram inverted index, with DataFrame functions only."""

from __future__ import annotations

import re._constants as rc
import re._parser as rp
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arpent.llm._shared import read, saved, small


@dataclass(frozen=True)
class Rule:
    """A kind of secret: matches of pattern whose group has at least min_length characters; a match that fails is used up."""

    kind: str
    pattern: str
    group: int = 0
    min_length: int = 1


#: Runs of [0-9a-f] or of AKIA[A-Z0-9] are maximal, so their least length may stand in the pattern itself.
RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
)

#: A part of a pattern stands for at most this many strings in its trigram query; beyond it, nothing is known of the part.
MOST_STRINGS = 64


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """The pattern's trigram query as an OR of ANDs of lower-case trigrams; [empty set] where no trigram is mandatory.

    Every text that the pattern matches has, lower-cased, all trigrams of one of the sets at least.
    """
    terms = {frozenset(x) for x in _need(list(rp.parse(pattern)))}
    return [t for t in terms if not any(o < t for o in terms)]


def _need(items: list) -> list[set[str]]:
    """OR of ANDs of trigrams for a sequence: the strings that each run of known parts can be, cut into trigrams."""
    terms, run = [set()], [""]

    def flush(terms: list[set[str]]) -> list[set[str]]:
        options = [{s[i : i + 3] for i in range(len(s) - 2)} for s in run]
        return [t | o for t in terms for o in options]

    for op, arg in items:
        strings = _strings([(op, arg)])
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = [a + b for a, b in product(run, strings)]
            continue
        terms, run = flush(terms), [""]
        if strings is not None:
            run = strings
        elif op is rc.SUBPATTERN:
            terms = [t | o for t in terms for o in _need(list(arg[3]))]
        elif op is rc.BRANCH:
            terms = [t | o for t in terms for b in arg[1] for o in _need(list(b))]
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[0] >= 1:
            terms = [t | o for t in terms for o in _need(list(arg[2]))]
    return flush(terms)


def _strings(items: list) -> list[str] | None:
    """All lower-case strings that a sequence matches, or None where they are unknown or too many."""
    out = [""]
    for op, arg in items:
        if op is rc.LITERAL:
            part = [chr(arg).lower()]
        elif op is rc.SUBPATTERN:
            part = _strings(list(arg[3]))
        elif op is rc.BRANCH:
            found = [_strings(list(b)) for b in arg[1]]
            part = None if None in found else [s for b in found for s in b]
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[1] != rc.MAXREPEAT and arg[1] <= 3:
            one = _strings(list(arg[2]))
            part = None if one is None or len(one) > 4 else ["".join(p) for n in range(arg[0], arg[1] + 1) for p in product(one, repeat=n)]
        else:
            part = None
        if part is None or len(out) * len(part) > MOST_STRINGS:
            return None
        out = [a + b for a, b in product(out, part)]
    return out


def postings(docs: DataFrame, key: Column, text: str, trigrams: list[str]) -> DataFrame:
    """(trigram, key): the inverted index over lower-cased texts, of the given trigrams, one row per text that has it."""
    found = F.transform(F.array(F.lower(text)), lambda low: F.filter(F.array(*[F.lit(t) for t in trigrams]), lambda t: F.contains(low, t)))[0]
    return docs.select(key.alias("key"), F.explode(found).alias("trigram"))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(key, rules): which indexed rules may match a text, from the intersected postings of their terms."""
    terms = [(r.kind, f"{r.kind}-{i}", t, len(term)) for r in rules for i, term in enumerate(trigram_query(r.pattern)) if term for t in term]
    plan = index.sparkSession.createDataFrame(terms or [("", "", "", -1)], "rule string, term string, trigram string, wanted int")
    held = index.join(F.broadcast(plan), "trigram").groupBy("key", "rule", "term", "wanted").agg(F.count_distinct("trigram").alias("n")).where("n = wanted")
    return held.groupBy("key").agg(F.collect_set("rule").alias("rules"))


def spans_of(text: Column, rule: Rule) -> Column:
    """Array of (start, end) in characters, ends exclusive, of a rule's matches: gaps and matches alternate along the text."""
    whole = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    steps = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), whole.alias("hit"), part.alias("part"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        fits = F.length(x["part"]) >= rule.min_length
        out = F.when(fits, F.concat(acc["out"], F.array(F.struct(start.alias("start"), end.alias("end"))))).otherwise(acc["out"])
        return F.struct(F.coalesce(end, start).alias("at"), out.alias("out"))

    found = F.aggregate(steps, zero, step, lambda acc: acc["out"])
    return F.when(F.size(whole) > 0, found).otherwise(zero["out"])


def _tagged(hits: Column, order: int, kind: str) -> Column:
    return F.transform(hits, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("order"), F.lit(kind).alias("kind"), s["end"].alias("end")))


def _count(kind: str, found: str = "_secrets") -> Column:
    return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text: str = "text", keys: tuple[str, ...] = ("doc_id",), found: str = "_secrets") -> DataFrame:
    """docs with the column `found`, an array of (start, order, kind, end) by start and then by the rules' order.

    The index holds the trigrams that some rule needs, for every text. A rule with a trigram query reads only texts that
    its intersected postings name, and verifies them with the pattern; a rule without mandatory trigrams (hex) reads all.
    Texts are matched with postings through a hash of keys and text, so that null or repeated ids do no harm: a clash of
    hashes only adds a candidate, which is verified. Candidates are broadcast where they are counted to be few, else
    joined by shuffle. Null and empty texts have no spans.
    """
    docs = docs.withColumn("__arpent_key", F.xxhash64(*keys, text))
    wanted = sorted({t for r in rules for term in trigram_query(r.pattern) for t in term})
    indexed = [r for r in rules if all(trigram_query(r.pattern))]
    if wanted:
        index = saved(postings(docs, F.col("__arpent_key"), text, wanted), "trigram-index")
        named = saved(candidates(index, tuple(indexed)).withColumnRenamed("key", "__arpent_key").withColumnRenamed("rules", "__arpent_rules"), "candidates")
        docs = docs.join(small(named), "__arpent_key", "left")
    else:
        docs = docs.withColumn("__arpent_rules", F.array().cast("array<string>"))
    none = F.array().cast("array<struct<start:int,end:int>>")
    tagged = []
    for i, r in enumerate(rules):
        held = F.coalesce(F.array_contains("__arpent_rules", r.kind), F.lit(False)) if r in indexed else F.lit(True)
        hits = F.coalesce(F.when(held & F.col(text).isNotNull(), spans_of(F.col(text), r)), none)
        tagged.append(_tagged(hits, i, r.kind))
    return docs.withColumn(found, F.array_sort(F.concat(*tagged))).drop("__arpent_key", "__arpent_rules")


def redact(docs: DataFrame, mark: str = "[secret]", text: str = "text", found: str = "_secrets") -> DataFrame:
    """Texts with every span in the column `found` replaced by the mark; spans that overlap are replaced as one."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] > acc["at"], F.concat(F.substring(F.col(text), acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
        first = F.when((s["start"] == 0) & (acc["at"] == 0), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], F.coalesce(gap, first, F.when(s["start"] == acc["at"], F.lit(mark)), F.lit(""))).alias("out"))

    clean = F.aggregate(found, zero, step, lambda acc: F.concat(acc["out"], F.substring(F.col(text), acc["at"] + 1, F.length(text))))
    return docs.withColumn(text, F.when(F.size(found) > 0, clean).otherwise(F.col(text))).drop(found)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    line = F.array_join(F.transform("_secrets", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return scan_secrets(docs).select("doc_id", *[_count(r.kind) for r in RULES], F.sha2(line, 256).alias("base_sha256"), line.alias("spans"))


QUERIES = {"op7_secret_scan": op7_secret_scan}

#: Gaps and matches alternate along a text, so running sums of their lengths are the spans.
ORACLES = {
    "op7_secret_scan": r"""
WITH d AS (
  SELECT row_number() OVER () AS i, doc_id, coalesce(text, '') AS t, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM documents
), found AS (
  SELECT i, 'assign' AS kind, 0 AS o, 8 AS least, string_split_regex(low, '(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([a-z0-9+/_.=-]+)') AS gaps,
    regexp_extract_all(low, '(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([a-z0-9+/_.=-]+)') AS hits,
    regexp_extract_all(low, '(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([a-z0-9+/_.=-]+)', 2) AS parts FROM d
  UNION ALL SELECT i, 'access', 1, 16, string_split_regex(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+'), regexp_extract_all(t, 'AKIA[A-Z0-9]+') FROM d
  UNION ALL SELECT i, 'hex', 2, 32, string_split_regex(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+'), regexp_extract_all(t, '[0-9a-f]+') FROM d
), one AS (
  SELECT i, kind, o, least, unnest(range(len(hits))) AS j, unnest(gaps[1:len(hits)]) AS gap, unnest(hits) AS hit, unnest(parts) AS part FROM found WHERE len(hits) > 0
), ended AS (
  SELECT *, CAST(sum(length(gap) + length(hit)) OVER (PARTITION BY i, o ORDER BY j) AS BIGINT) AS e FROM one
), span AS (SELECT i, kind, o, e - length(hit) AS s, e FROM ended WHERE length(part) >= least),
line AS (
  SELECT i, string_agg(concat_ws(':', kind, s, e), ',' ORDER BY s, o) AS spans, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex
  FROM span GROUP BY i
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN line USING (i)
"""
}
