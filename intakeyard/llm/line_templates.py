"""Line dedup by a log-template tree of fixed depth.

A line's tokens (runs without ASCII white space; a token with a digit is a variable field) lead it
through the tree: token count, then its first ``depth`` tokens. In a leaf that lines of at least
``min_docs`` different texts reach, every position is looked at: a token that
``min_docs`` or more lines of different texts carry there belongs to the template, anything else is generalised
to a variable field. A template recurs if lines of ``min_docs`` different texts fall on it and
at least ``constant`` of its positions are no variable fields; its lines are dropped from all texts.
Lines of more than ``long_line`` tokens don't recur by chance, so for them ``long_docs`` texts are enough wherever
``min_docs`` is named here; a leaf holds lines of one token count, so it is of one kind.

All of it is grouped counts and equi-joins. Lines of leaves that too few texts reach leave after the
first count. Identical texts count once, so copies of one text don't make its lines recur.
Counts are pre-aggregated, and a hot line is one row per text from then on.

Defined results: null and empty texts have no lines to drop; lines under ``min_tokens`` tokens always
stay (with ``classes``, white lines do); a text whose lines all go becomes empty, the row stays; repeated rows lose the same lines; null ids are values
like any other; an empty table gives an empty result. Only the id and the text are read; ``carry`` columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from intakeyard.llm.common import documents, row_key, saved

VARIABLE = "<*>"
DEPTH, MIN_DOCS, MIN_TOKENS, CONSTANT, LONG_LINE, LONG_DOCS = 3, 10, 3, 0.75, 50, 5
#: With groups of near copies: a long line that is the same in so many groups recurs.
LONG_SAME = 2


def masked(line: Column) -> Column:
    """A line's tokens with one space between them, variable ones masked. Most lines are their own result."""
    plain = ~(line.rlike(r"[0-9\t\r\x0b\x0c]") | _uneven(line))
    return F.when(plain, line).otherwise(_even(F.regexp_replace(line, r"[^\x20\x09-\x0D0-9]*[0-9][^\x20\x09-\x0D]*", VARIABLE)))


def _uneven(line: Column) -> Column:
    return F.contains(line, F.lit("  ")) | F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))


def _even(line: Column) -> Column:
    return F.array_join(F.array_remove(F.split(F.translate(line, "\t\r\x0b\x0c", "    "), " "), ""), " ")


def _once(c: Column) -> Column:
    """``c`` made nondeterministic at no cost (a partition id is never negative): a filter on it is not pushed below its projection,
    where it would parse every line a second time."""
    return F.when(F.spark_partition_id() >= 0, c)


def _parsed(docs: DataFrame, id_col: str, text_col: str, depth: int, long_line: int) -> DataFrame:
    """``(key, same, at, line, n, leaf, tokens)`` of every line: ``n`` tokens, joined by spaces; ``same`` tells texts apart.
    The lowest bit of a leaf says if its lines are long."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    tokens = F.col("tokens")
    n = F.when(tokens == "", 0).otherwise(F.length(tokens) - F.length(F.replace(tokens, F.lit(" "), F.lit(""))) + 1)
    leaf = F.xxhash64("n", F.slice(F.split(tokens, " ", depth + 1), 1, depth)).bitwiseAND(F.lit(~1)).bitwiseOR((F.col("n") > long_line).cast("bigint"))
    return (docs.select(row_key(id_col, text_col).alias("key"), F.xxhash64(text).alias("same"), text.alias("text"))
            .select("key", "same", F.posexplode(F.split("text", "\n")).alias("at", "line"))
            .select("key", "same", "at", "line", _once(masked(F.col("line"))).alias("tokens"))
            .select("*", _once(n).alias("n")).select("*", leaf.alias("leaf")))


def recurring_lines(docs: DataFrame, id_col: str, text_col: str, depth: int, min_docs: int, min_tokens: int, constant: float,
                    long_line: int, long_docs: int) -> DataFrame:
    """``(key, at)`` of every line (0-based) that falls on a recurring template. The lowest bit of a leaf says if its lines are long."""
    enough = F.when(F.col("leaf").bitwiseAND(F.lit(1)) == 1, F.lit(long_docs)).otherwise(F.lit(min_docs))
    lines = _parsed(docs, id_col, text_col, depth, long_line).where(F.col("n") >= min_tokens).select("key", "same", "at", "leaf", "tokens")
    leaves = (lines.select("leaf", "same").distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("texts"))
              .where(F.col("texts") >= enough).select("leaf"))
    inside = saved(lines.join(leaves, "leaf").withColumn("line", F.xxhash64("tokens")))
    # each different line of a leaf once, with the number of texts that hold it
    kinds = saved(inside.groupBy("leaf", "line", "same").agg(F.min("tokens").alias("tokens"))
                  .groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("texts"), F.min("tokens").alias("tokens")))
    cells = kinds.select("leaf", "line", "texts", F.posexplode(F.split("tokens", " ")).alias("pos", "token"))
    firm = cells.groupBy("leaf", "pos", "token").agg(F.sum("texts").alias("seen")).where((F.col("seen") >= enough) & (F.col("token") != VARIABLE))
    marked = cells.join(firm.select("leaf", "pos", "token", F.lit(True).alias("firm")), ["leaf", "pos", "token"], "left")
    template = marked.groupBy("leaf", "line").agg(
        F.count("firm").alias("firm"), F.count(F.lit(1)).alias("size"),
        F.bit_xor(F.when(F.col("firm"), F.xxhash64("pos", "token"))).alias("t1"),
        F.bit_xor(F.when(F.col("firm"), F.xxhash64("token", "pos"))).alias("t2"))
    on = inside.select("key", "at", "same", "leaf", "line").join(
        template.where(F.col("firm") >= constant * F.col("size")).select("leaf", "line", "t1", "t2"), ["leaf", "line"])
    often = (on.select("leaf", "t1", "t2", "same").distinct().groupBy("leaf", "t1", "t2").agg(F.count(F.lit(1)).alias("texts"))
             .where(F.col("texts") >= enough).drop("texts"))
    return on.join(often, ["leaf", "t1", "t2"]).select("key", "at")


def spread_lines(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, depth: int, min_docs: int, constant: float,
                 long_line: int, long_docs: int) -> DataFrame:
    """``(key, at)`` of every line on a template that recurs, with positions decided by spread instead of a fixed count.

    The tokens of a line are put in the order in which their leaf holds them, the commonest first. Every head of that order with at least
    ``constant`` of the positions is a template the line falls on, the rest being variable fields. It recurs if lines of
    ``min_docs`` (``long_docs``) groups of near copies fall on it, so a field may have many values that are common themselves.
    ``classes`` has ``(key, component)``, the group of each text: near copies of one text don't make its lines recur.
    A line of any length recurs by itself if it is the same, digits included, in ``min_docs`` groups (a long one in ``LONG_SAME``);
    the constant share is asked of lines that differ only.
    """
    least = F.when(F.col("leaf").bitwiseAND(F.lit(1)) == 1, F.lit(LONG_SAME)).otherwise(F.lit(min_docs))
    enough = F.when(F.col("leaf").bitwiseAND(F.lit(1)) == 1, F.lit(long_docs)).otherwise(F.lit(min_docs))
    own = F.when(F.col("line").rlike("[0-9]"), F.xxhash64(_even(F.col("line")))).otherwise(F.xxhash64("tokens"))  # no digits: nothing was masked
    lines = (_parsed(docs, id_col, text_col, depth, long_line).where(F.col("n") > 0)
             .select("key", "same", "at", own.alias("own"), "leaf", "tokens"))
    leaves = (lines.select("leaf", "same").distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("texts"))
              .where(F.col("texts") >= least).select("leaf"))
    groups = classes.select("key", F.xxhash64("component").alias("group"))
    inside = saved(lines.join(leaves, "leaf").join(groups, "key").withColumn("line", F.xxhash64("tokens"))
                   .select("key", "at", F.col("group").alias("same"), "leaf", "line", "own", "tokens"))
    # leaves of enough texts, but of few groups, leave here
    leaves = (inside.select("leaf", "same").distinct().groupBy("leaf").agg(F.count(F.lit(1)).alias("texts"))
              .where(F.col("texts") >= enough).select("leaf"))
    holders = inside.groupBy("leaf", "line", "same").agg(F.min("tokens").alias("tokens"))
    kinds = saved(holders.groupBy("leaf", "line").agg(F.count(F.lit(1)).alias("texts"), F.min("tokens").alias("tokens")).join(leaves, "leaf"))
    cells = (kinds.select("leaf", "line", "texts", F.size(F.split("tokens", " ")).alias("n"), F.posexplode(F.split("tokens", " ")).alias("pos", "token"))
             .where(F.col("token") != VARIABLE).select("leaf", "line", "texts", "n", F.xxhash64("pos", "token").alias("cell")))
    # a cell that too few texts hold is in no template that recurs
    seen = cells.groupBy("leaf", "cell").agg(F.sum("texts").alias("seen")).where(F.col("seen") >= enough)
    order = Window.partitionBy("leaf", "line").orderBy(F.desc("seen"), "cell")
    head = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    heads = saved(cells.join(seen, ["leaf", "cell"])
                  .select("leaf", "line", "texts", "n", F.row_number().over(order).alias("firm"), F.bit_xor("cell").over(head).alias("t1"),
                          F.bit_xor(F.xxhash64("cell")).over(head).alias("t2"))
                  .where(F.col("firm") >= constant * F.col("n")).select("leaf", "t1", "t2", "line", "texts"))
    sums = heads.groupBy("leaf", "t1", "t2").agg(F.max("texts").alias("most"), F.sum("texts").alias("sum")).where(F.col("sum") >= enough)
    # one line of enough texts settles its templates; for others each line has few texts, and these are counted once
    sure = sums.where(F.col("most") >= enough).select("leaf", "t1", "t2")
    counted = (heads.join(sums.where(F.col("most") < enough).select("leaf", "t1", "t2"), ["leaf", "t1", "t2"])
               .join(holders.select("leaf", "line", "same"), ["leaf", "line"]).select("leaf", "t1", "t2", "same").distinct()
               .groupBy("leaf", "t1", "t2").agg(F.count(F.lit(1)).alias("texts")).where(F.col("texts") >= enough).drop("texts"))
    gone = heads.join(sure.union(counted), ["leaf", "t1", "t2"], "left_semi").select("leaf", "line").distinct()
    alike = (inside.select("leaf", "own", "same").distinct().groupBy("leaf", "own").agg(F.count(F.lit(1)).alias("texts"))
             .where(F.col("texts") >= least).select("leaf", "own"))
    return (inside.join(gone, ["leaf", "line"], "left_semi").select("key", "at")
            .union(inside.join(alike, ["leaf", "own"], "left_semi").select("key", "at")))


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, carry: list[str] | None = None, depth: int = DEPTH,
               min_docs: int = MIN_DOCS, min_tokens: int = MIN_TOKENS, constant: float = CONSTANT, long_line: int = LONG_LINE,
               long_docs: int = LONG_DOCS, classes: DataFrame | None = None) -> DataFrame:
    """``carry`` columns with ``n_lines``, ``n_dropped`` and ``kept_text``; added names win over carried ones.

    With ``classes`` (``near_dedup.near_classes``) the rule is that of ``spread_lines`` (the pipeline's stage,
    which knows no ``min_tokens``), else that of ``ORACLE``."""
    added = ["n_lines", "n_dropped", "kept_text"]
    carried = [c for c in carry or [] if c.lower() not in added]
    if classes is None:
        found = recurring_lines(docs, id_col, text_col, depth, min_docs, min_tokens, constant, long_line, long_docs)
    else:
        found = spread_lines(docs, classes, id_col, text_col, depth, min_docs, constant, long_line, long_docs)
    gone = found.groupBy("key").agg(F.collect_set("at").alias("__gone"))
    source = (docs.select(*[F.col(f"`{c}`") for c in carried], F.col(text_col).alias("__text"), row_key(id_col, text_col).alias("__key"))
              .join(gone.withColumnRenamed("key", "__key").hint("shuffle_hash"), "__key", "left"))
    kept = F.array_join(F.filter(F.split("__text", "\n"), lambda line, at: ~F.array_contains("__gone", at)), "\n")
    total = F.when(F.coalesce(F.length("__text"), F.lit(0)) > 0, F.size(F.split("__text", "\n"))).otherwise(0)
    return source.select(*[F.col(f"`{c}`") for c in carried], total.cast("bigint").alias("n_lines"),
                         F.when(F.col("__gone").isNull(), 0).otherwise(F.size("__gone")).cast("bigint").alias("n_dropped"),
                         F.when(F.col("__gone").isNull(), F.col("__text")).otherwise(kept).alias("kept_text"))


def op10_line_templates(spark, sf_dir):
    out = line_dedup(documents(spark, sf_dir), carry=["doc_id"])
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = r"""
WITH split AS (SELECT doc_id, coalesce(text, '') AS text, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                      generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no FROM documents),
masked AS (SELECT doc_id, text, line, line_no, regexp_extract_all(
               regexp_replace(line, '[^\x20\x09-\x0D0-9]*[0-9][^\x20\x09-\x0D]*', '<*>', 'g'), '[^\x20\x09-\x0D]+') AS tokens FROM split),
lines AS (SELECT *, len(tokens) AS n, tokens[1:3] AS path FROM masked WHERE len(tokens) >= 3),
leaves AS (SELECT n, path FROM lines GROUP BY n, path HAVING count(DISTINCT text) >= if(n > 50, 5, 10)),
inside AS (SELECT lines.* FROM lines JOIN leaves USING (n, path)),
kinds AS (SELECT n, path, tokens, count(DISTINCT text) AS texts FROM inside GROUP BY n, path, tokens),
cells AS (SELECT n, path, tokens, texts, unnest(tokens) AS token, generate_subscripts(tokens, 1) AS pos FROM kinds),
firm AS (SELECT n, path, pos, token FROM cells WHERE token <> '<*>' GROUP BY n, path, pos, token HAVING sum(texts) >= if(n > 50, 5, 10)),
template AS (SELECT c.n, c.path, c.tokens, list(CASE WHEN f.token IS NULL THEN '<*>' ELSE c.token END ORDER BY c.pos) AS t,
                    count(f.token) AS firm FROM cells c LEFT JOIN firm f ON c.n = f.n AND c.path = f.path AND c.pos = f.pos AND c.token = f.token
             GROUP BY c.n, c.path, c.tokens),
onto AS (SELECT i.doc_id, i.text, i.line_no, i.n, i.path, t.t FROM inside i JOIN template t ON i.n = t.n AND i.path = t.path AND i.tokens = t.tokens
         WHERE t.firm >= 0.75 * t.n),
often AS (SELECT n, path, t FROM onto GROUP BY n, path, t HAVING count(DISTINCT text) >= if(n > 50, 5, 10)),
gone AS (SELECT DISTINCT doc_id, line_no FROM onto JOIN often USING (n, path, t)),
kept AS (SELECT s.doc_id, any_value(CASE WHEN s.text = '' THEN 0 ELSE len(string_split(s.text, chr(10))) END) AS n_lines, count(g.line_no) AS n_dropped,
                coalesce(string_agg(s.line, chr(10) ORDER BY s.line_no) FILTER (WHERE g.line_no IS NULL), '') AS kept
         FROM split s LEFT JOIN gone g ON s.doc_id = g.doc_id AND s.line_no = g.line_no GROUP BY s.doc_id)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, sha256(kept) AS kept_sha256 FROM kept
"""
