"""Line dedup by a tree of line templates.

Lines are parsed into a tree of fixed depth: first by token count, then by their leading
tokens, a token with a digit counting as variable. Within a leaf, a token that stands at its
place in enough (text, line) pairs is constant, any other is a variable field; the line
with its variable fields masked is its template. A template that is constant over
``similarity`` of its tokens and recurs in ``min_texts`` different texts is boilerplate, and
its lines are dropped from every document. Copies of a whole text count once, so a copied
document does not make its own lines recur.

Lines of a recurring leaf are the only ones looked at token by token, and each different
line once. Counts are aggregated in the map tasks first; a hot leaf or template is a
grouped count, never a gathered group.

Defined results: lines end at line feeds and are parted at blanks and tabs; lines with fewer
than ``min_tokens`` tokens are always kept. A null text stays null with 0 lines; an empty text
has one empty line. Repeated rows and keys stay, other columns pass through. Only
DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from review_engine.llm.common import written

MIN_TEXTS = 5
MIN_TOKENS = 5
LEADING = 3
SIMILARITY = 0.7
VARIABLE = "<*>"


def _tokens(line: Column) -> Column:
    return F.split(F.trim(line), "[ \t]+")


def _masked(token: Column) -> Column:
    return F.when(token.rlike("[0-9]"), F.lit(VARIABLE)).otherwise(token)


def _text_id(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def lines_of(docs: DataFrame, text: str, min_tokens: int, leading: int) -> DataFrame:
    """Long enough lines: text id, line number, the line and its leaf in the tree."""
    lines = docs.where(F.col(text).isNotNull()).select(
        _text_id(F.col(text)).alias("t"), F.posexplode(F.split(F.col(text), "\n")).alias("line_no", "line"))
    cut = lines.withColumn("tokens", _tokens(F.col("line"))).where(F.size("tokens") >= min_tokens)
    leaf = F.xxhash64(F.size("tokens"), *[_masked(F.get("tokens", F.lit(i))) for i in range(leading)])
    return cut.select("t", "line_no", "line", leaf.alias("leaf"))


def templates(lines: DataFrame, min_texts: int, similarity: float) -> tuple[DataFrame, DataFrame]:
    """The lines of recurring templates (leaf, line_id), and all lines of recurring leaves."""
    leaves = lines.groupBy("leaf", "t").agg(F.lit(1).alias("one")).groupBy("leaf").agg(F.count("*").alias("texts"))
    candidates = written(
        lines.join(leaves.where(F.col("texts") >= min_texts), "leaf", "left_semi")
        .withColumn("line_id", F.unhex(F.md5(F.col("line").cast("binary")))), "template-lines")
    # Each different line once, with the number of texts that hold it.
    pairs = written(candidates.groupBy("leaf", "line_id", "t").agg(F.lit(1).alias("one")).drop("one"), "template-pairs")
    texts = pairs.groupBy("leaf", "line_id").agg(F.count("*").alias("texts"))
    spelled = candidates.groupBy("leaf", "line_id").agg(F.min("line").alias("line"))
    tokens = texts.join(spelled, ["leaf", "line_id"]).select(
        "leaf", "line_id", "texts", F.posexplode(_tokens(F.col("line"))).alias("at", "token")).withColumn(
        "token", _masked(F.col("token")))
    tokens = written(tokens, "template-tokens")
    constant = (tokens.where(F.col("token") != VARIABLE).groupBy("leaf", "at", "token").agg(F.sum("texts").alias("n"))
                .where(F.col("n") >= min_texts).select("leaf", "at", "token", F.lit(True).alias("constant")))
    fields = tokens.join(constant, ["leaf", "at", "token"], "left").select(
        "leaf", "line_id", "at", F.when(F.col("constant"), F.col("token")).alias("fixed"))
    # Gathers the tokens of one line.
    named = fields.groupBy("leaf", "line_id").agg(
        F.avg(F.col("fixed").isNotNull().cast("double")).alias("share"),
        F.array_sort(F.collect_list(F.struct("at", F.coalesce("fixed", F.lit(VARIABLE)).alias("token")))).alias("f")).where(
        F.col("share") >= similarity).select(
        "leaf", "line_id", F.unhex(F.md5(F.array_join(F.col("f.token"), " ").cast("binary"))).alias("template"))
    named = written(named, "template-names")
    recurring = (pairs.join(named, ["leaf", "line_id"]).groupBy("leaf", "template", "t").agg(F.lit(1).alias("one"))
                 .groupBy("leaf", "template").agg(F.count("*").alias("texts")).where(F.col("texts") >= min_texts))
    return named.join(recurring, ["leaf", "template"], "left_semi").select("leaf", "line_id"), candidates


def drop_recurring_lines(docs: DataFrame, text: str = "text", min_texts: int = MIN_TEXTS, min_tokens: int = MIN_TOKENS,
                         leading: int = LEADING, similarity: float = SIMILARITY) -> DataFrame:
    """Documents with recurring lines taken out of ``text``; adds ``n_lines`` and ``n_dropped``."""
    docs = docs.drop("n_lines", "n_dropped")
    recurring, candidates = templates(lines_of(docs, text, min_tokens, leading), min_texts, similarity)
    drops = (candidates.join(recurring, ["leaf", "line_id"], "left_semi")
             .groupBy("t").agg(F.collect_set("line_no").alias("_drops")))
    marked = docs.withColumn("_t", _text_id(F.col(text)))
    joined = marked.join(drops.withColumnRenamed("t", "_t"), "_t", "left")
    lines = F.split(F.col(text), "\n")
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains(F.col("_drops"), i)), "\n")
    others = [c for c in docs.columns if c != text]
    return joined.select(
        *[F.col(f"`{c}`") for c in others],
        F.when(F.col("_drops").isNull(), F.col(text)).otherwise(kept).alias(text),
        F.when(F.col(text).isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"),
        F.when(F.col("_drops").isNull(), 0).otherwise(F.size("_drops")).cast("long").alias("n_dropped"))


SQL = f"""WITH d AS (SELECT doc_id, text, md5(text) AS t FROM documents),
l0 AS (SELECT DISTINCT t, i AS line_no, string_split(text, chr(10))[i] AS line
       FROM (SELECT t, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM d WHERE text IS NOT NULL)),
l1 AS (SELECT *, regexp_split_to_array(trim(line), '[ \t]+') AS tokens FROM l0),
l AS (SELECT t, line_no, line, tokens,
             [len(tokens)::VARCHAR, {', '.join(f"CASE WHEN regexp_matches(tokens[{i + 1}], '[0-9]') THEN '{VARIABLE}' ELSE tokens[{i + 1}] END" for i in range(LEADING))}] AS leaf
      FROM l1 WHERE len(tokens) >= {MIN_TOKENS}),
c AS (SELECT * FROM l WHERE leaf IN (SELECT leaf FROM l GROUP BY leaf HAVING count(DISTINCT t) >= {MIN_TEXTS})),
u AS (SELECT leaf, line, any_value(tokens) AS tokens, count(DISTINCT t) AS texts FROM c GROUP BY leaf, line),
k AS (SELECT leaf, line, texts, i AS pos, CASE WHEN regexp_matches(tokens[i], '[0-9]') THEN '{VARIABLE}' ELSE tokens[i] END AS token
      FROM (SELECT *, unnest(range(1, len(tokens) + 1)) AS i FROM u)),
s AS (SELECT leaf, pos, token FROM k WHERE token <> '{VARIABLE}' GROUP BY ALL HAVING sum(texts) >= {MIN_TEXTS}),
n AS (SELECT k.leaf, k.line, avg((s.token IS NOT NULL)::INTEGER) AS share,
             list(coalesce(s.token, '{VARIABLE}') ORDER BY k.pos) AS template
      FROM k LEFT JOIN s ON k.leaf = s.leaf AND k.pos = s.pos AND k.token = s.token
      GROUP BY k.leaf, k.line HAVING avg((s.token IS NOT NULL)::INTEGER) >= {SIMILARITY}),
r AS (SELECT n.leaf, n.template FROM n JOIN c ON n.leaf = c.leaf AND n.line = c.line
      GROUP BY ALL HAVING count(DISTINCT c.t) >= {MIN_TEXTS}),
x AS (SELECT DISTINCT c.t, c.line_no FROM c JOIN n ON n.leaf = c.leaf AND n.line = c.line
      JOIN r ON r.leaf = n.leaf AND r.template = n.template),
o AS (SELECT l0.t, count(x.t) AS n_dropped, count(*) AS n_lines,
             string_agg(l0.line, chr(10) ORDER BY l0.line_no) FILTER (WHERE x.t IS NULL) AS kept
      FROM l0 LEFT JOIN x ON l0.t = x.t AND l0.line_no = x.line_no GROUP BY l0.t)
SELECT d.doc_id, CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(o.kept, '') END AS text,
       coalesce(o.n_lines, 0)::BIGINT AS n_lines, coalesce(o.n_dropped, 0)::BIGINT AS n_dropped
FROM d LEFT JOIN o ON d.t = o.t"""
