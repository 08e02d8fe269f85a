"""Secret scan with a trigram inverted index, in DataFrame functions only.

From each rule's regex the strings that any match must hold are derived
(``mandatory``): a conjunction of alternatives, each a set of lower-cased trigrams. The index has one
posting (trigram, document) for every trigram some rule asks for; postings are intersected per document
and rule, and only the documents left are joined back to their texts and verified with the regex.
Rules without a mandatory trigram (the hex rule) scan all texts where they are read, without a shuffle.

Offsets are running sums of the lengths between and of the matches, in code points.

Defined results: null and empty texts have no spans; equal spans of different kinds all count;
repeated rows get equal results; null ids are values like any other; an empty table gives an empty result. Only the
id and the text are read.
"""

from __future__ import annotations

import re._constants as rc
import re._parser as rp
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intakeyard.llm.common import documents, keyed, row_key, saved


@dataclass(frozen=True)
class Rule:
    """``regex`` matches leftmost, non-overlapping; a match counts if ``group`` has ``least`` characters."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1


#: The three base rules, then those this scan adds. Dropping matches below a length is written into the
#: regex where a shorter match can't hide a longer one (access, hex and the added rules).
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
ADDED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN\x20[A-Z\x20]*PRIVATE\x20KEY-----"),
)
#: Alternatives kept while a regex is expanded; beyond it the part gives no condition.
FEW = 64


def _exact(items) -> set[str] | None:
    """All lower-cased strings a regex part can match, or None if they are too many."""
    out = {""}
    for op, arg in items:
        if op is rc.LITERAL:
            step = {chr(arg).lower()}
        elif op is rc.IN and all(o is rc.LITERAL for o, _ in arg):
            step = {chr(a).lower() for _, a in arg}
        elif op is rc.SUBPATTERN:
            step = _exact(arg[3])
        elif op is rc.BRANCH:
            parts = [_exact(p) for p in arg[1]]
            step = None if None in parts else set().union(*parts)
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[0] == arg[1] or op is rc.MAX_REPEAT and tuple(arg[:2]) == (0, 1):
            once = _exact(arg[2])
            step = None if once is None or arg[1] > 8 else {""} | once if arg[0] == 0 else reduce(lambda a, _: {x + y for x in a for y in once}, range(arg[1]), {""})
        elif op is rc.AT:
            continue
        else:
            step = None
        if step is None or len(out) * len(step) > FEW:
            return None
        out = {a + b for a in out for b in step}
    return out


def _parts(items) -> list[set[str]]:
    """Conjunction of alternatives of lower-cased strings that every match holds somewhere."""
    out, run = [], []

    def close() -> None:
        got = _exact(run) if run else None
        if got and min(map(len, got)) >= 3:
            out.append(got)
        run.clear()

    for item in items:
        op, arg = item
        if _exact([*run, item]) is not None:
            run.append(item)
            continue
        close()
        if _exact([item]) is not None:
            run.append(item)
        elif op is rc.SUBPATTERN:
            out.extend(_parts(arg[3]))
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT) and arg[0] >= 1:
            out.extend(_parts(arg[2]))
    close()
    return out


def mandatory(regex: str) -> list[list[frozenset[str]]]:
    """Boolean trigram query of a regex: all of (any of (all trigrams of a set)); empty if it gives none."""
    return [sorted({frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in part}, key=sorted) for part in _parts(rp.parse(regex))]


def postings(rows: DataFrame, grams: list[str]) -> DataFrame:
    """The index: one ``(gram, key)`` for every asked trigram that a document's lower-cased text holds."""
    low = rows.select("key", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams]))
    return low.select("key", F.explode(held).alias("gram"))


def candidate_documents(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """``(key, rules)``: the rules whose trigram query a document's postings satisfy."""
    def all_of(grams: frozenset[str]) -> Column:
        return reduce(lambda a, b: a & b, [F.array_contains("grams", g) for g in sorted(grams)])

    def holds(rule: Rule) -> Column:
        return reduce(lambda a, b: a & b, [reduce(lambda a, b: a | b, map(all_of, part)) for part in mandatory(rule.regex)])

    grouped = index.groupBy("key").agg(F.collect_set("gram").alias("grams"))  # at most as many as the rules ask for
    named = F.array_compact(F.array(*[F.when(holds(r), F.lit(r.kind)) for r in rules]))
    return grouped.select("key", named.alias("rules")).where("size(rules) > 0")


def _matches(rows: DataFrame, rule: Rule, rank: int) -> DataFrame:
    """One row per match: its place, the text between it and the match before, its own length."""
    between, whole = F.split("text", rule.regex, -1), F.regexp_extract_all("text", F.lit(rule.regex), F.lit(0))
    tested = F.regexp_extract_all("text", F.lit(rule.regex), F.lit(rule.group)) if rule.group else whole
    found = rows.where(F.col("text").rlike(rule.regex)).select("key", F.posexplode(F.arrays_zip(
        F.transform(between, F.length).alias("gap"), F.transform(whole, F.length).alias("size"), F.transform(tested, F.length).alias("tested"))).alias("i", "m"))
    return found.where("m.size IS NOT NULL").select("key", F.lit(rank).alias("rank"), F.lit(rule.kind).alias("kind"), "i", "m.gap", "m.size",
                                                    (F.col("m.tested") >= rule.least).alias("counts"))


def secret_spans(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(key, rank, kind, start, end)`` of every span that counts; ``rows`` has ``key`` and ``text``."""
    indexed = [r for r in rules if mandatory(r.regex)]
    grams = sorted({g for r in indexed for part in mandatory(r.regex) for alt in part for g in alt})
    parts = [_matches(rows, r, k) for k, r in enumerate(rules) if r not in indexed]
    if indexed:
        chosen = saved(candidate_documents(postings(rows, grams), indexed))
        texts = saved(rows.join(chosen.hint("shuffle_hash"), "key"))
        parts += [_matches(texts.where(F.array_contains("rules", r.kind)), r, k) for k, r in enumerate(rules) if r in indexed]
    found = reduce(DataFrame.unionByName, parts).distinct()  # repeated rows share a key
    before = Window.partitionBy("key", "rank").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("size")).over(before)
    return found.withColumn("end", end).where("counts").select("key", "rank", "kind", (F.col("end") - F.col("size")).alias("start"), "end")


def secret_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, base: tuple[Rule, ...] = BASE,
                added: tuple[Rule, ...] = ADDED) -> DataFrame:
    """``(id_col, n_<kind> of the base rules, base_sha256, spans)`` for every row of ``docs``."""
    rows = keyed(docs, id_col, text_col)
    spans = secret_spans(rows.select("key", "text"), base + added)
    text = F.concat_ws(":", "kind", "start", "end")
    per = spans.groupBy("key").agg(
        *[F.count_if(F.col("rank") == k).alias(f"n_{r.kind}") for k, r in enumerate(base)],
        F.array_sort(F.collect_list(F.struct("start", "rank", "end", text.alias("span")))).alias("all"))
    thin = docs.select(F.col(id_col).alias("id"), row_key(id_col, text_col).alias("key"))
    every = F.coalesce("all", F.array().cast(per.schema["all"].dataType))
    return thin.join(per, "key", "left").select(
        F.col("id").alias(id_col), *[F.coalesce(f"n_{r.kind}", F.lit(0)).cast("long").alias(f"n_{r.kind}") for r in base],
        F.sha2(F.array_join(F.filter(every, lambda x: x["rank"] < len(base))["span"], ","), 256).alias("base_sha256"),
        F.array_join(every["span"], ",").alias("spans"))


def op6_secret_scan(spark, sf_dir):
    return secret_scan(documents(spark, sf_dir))


def _oracle() -> str:
    parts = []
    for k, r in enumerate(BASE + ADDED):
        rx = r.regex.replace("'", "''")
        parts.append(f"""SELECT doc_id, {k} AS rank, '{r.kind}' AS kind, unnest(list_transform(range(1, len(m) + 1), lambda i:
            {{'e': CAST(list_sum(list_transform(g[1:i], lambda x: length(x))) + list_sum(list_transform(m[1:i], lambda x: length(x))) AS BIGINT),
              'n': length(m[i]), 'ok': length(t[i]) >= {r.least}}})) AS s
            FROM (SELECT doc_id, string_split_regex(text, '{rx}') AS g, regexp_extract_all(text, '{rx}', 0) AS m,
                         regexp_extract_all(text, '{rx}', {r.group}) AS t FROM documents WHERE text IS NOT NULL)""")
    union = "\nUNION ALL\n".join(parts)
    return f"""
WITH found AS ({union}),
spans AS (SELECT doc_id, rank, kind, s.e - s.n AS start, kind || ':' || (s.e - s.n) || ':' || s.e AS span FROM found WHERE s.ok),
per AS (SELECT doc_id, {", ".join(f"count(*) FILTER (WHERE rank = {k}) AS n_{r.kind}" for k, r in enumerate(BASE))},
               string_agg(span, ',' ORDER BY start, rank) FILTER (WHERE rank < {len(BASE)}) AS base, string_agg(span, ',' ORDER BY start, rank) AS spans
        FROM spans GROUP BY doc_id)
SELECT d.doc_id, {", ".join(f"CAST(coalesce(n_{r.kind}, 0) AS BIGINT) AS n_{r.kind}" for r in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM documents d LEFT JOIN per USING (doc_id)"""


ORACLE = _oracle()
