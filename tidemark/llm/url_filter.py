"""URL filter by a path-template tree with smoothed labelled purity.

DataFrame functions only.

1. *Tree.*  Each host is a root; path segments are its levels.  At a node a segment stays a
   branch of its own when it covers at least ``MIN_ROWS`` rows, whatever its share of the node's; all others are
   variable and become the wildcard ``*``.  One pass a level goes down as far as a node has ``MIN_ROWS`` rows; what lies below
   level ``DEPTH`` and below the last branch becomes one tail, ``**``.
2. *Merging.*  Leaves under one parent whose share of good labels does not differ from the parent's
   by ``SIGMAS`` standard errors are merged and share their labels.
3. *Verdict.*  The smoothed share of good pages of a template, (good + A h) / (labelled + A) with h the host's own smoothed
   share, decides: below ``PURITY`` its pages are blocked.
4. Rules (verdict, host, path) come first: a rule fits its host and all subdomains where the path starts with the rule's; the longest wins.

A page is good when labels with its id say quality 1 and not toxic.

Edge cases: a null url, or one without ``://``, has an empty host and path and is a template of its own; null labels count as not labelled; rows
that repeat a page_id are judged one by one; a page_id with several labels is good only if all say so; an empty
table gives an empty result.

``oracle_sql`` unrolls ``DEPTH`` levels, so it has no branch below them: the same rows where no ``MIN_ROWS`` pages share a deeper node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import save

# Verdict, host, path.
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/"))
DEPTH = 6
MIN_ROWS = 8
SIGMAS = 2.0
SMOOTHING = 10.0
PURITY = 0.5

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    part = lambda k: F.coalesce(F.regexp_extract(url, _PARTS, k), F.lit(""))
    return F.translate(part(1), _UPPER, _LOWER), part(2)


def apply_rules(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule (host and path as one string) and its verdict, both null without one."""
    rule = verdict = F.lit(None).cast("string")
    for decision, where, start in sorted(rules, key=lambda r: len(r[1] + r[2])):  # the longest is asked first
        fits = ((host == where) | host.endswith(f".{where}")) & path.startswith(start)
        rule, verdict = F.when(fits, where + start).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def grow_templates(pages: DataFrame, depth: int = DEPTH, min_rows: int = MIN_ROWS) -> DataFrame:
    """Add parent and template to rows with host and path, one level after another."""
    segments = F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(F.split(F.substr("path", F.lit(2)), "/"))
    rows = pages.withColumn("segments", segments)
    for name in ("parent", "template", "branch"):  # branch: the template down to its last branch, or to `depth`
        rows = rows.withColumn(name, F.lit(""))
    rows = save(rows, "level")
    deepest = rows.agg(F.max(F.size("segments"))).first()[0] or 0
    ready, open_ended = [], False
    for level in range(1, deepest + 1):
        if level > depth:
            ready.append(rows.where(F.size("segments") < level))
            rows = rows.where(F.size("segments") >= level)
            if rows.groupBy("host", "template").count().where(F.col("count") >= min_rows).isEmpty():
                open_ended = True  # no branch lies deeper
                break
        here = rows.where(F.size("segments") >= level).select("host", "template", F.element_at("segments", level).alias("segment"))
        counts = here.groupBy("host", "template", "segment").agg(F.count("*").alias("n"))
        kept = counts.where(F.col("n") >= min_rows).select("host", "template", "segment", F.lit(True).alias("own"))
        there = F.size("segments") >= level
        rows = rows.withColumn("segment", F.when(there, F.element_at("segments", F.least(F.lit(level), F.greatest(F.size("segments"), F.lit(1))))))
        rows = rows.join(kept, ["host", "template", "segment"], "left")
        step = F.concat("template", F.lit("/"), F.when(F.col("own"), F.col("segment")).otherwise("*"))
        rows = rows.withColumn("parent", F.when(there, F.col("template")).otherwise(F.col("parent"))).withColumn("template", F.when(there, step).otherwise(F.col("template")))
        told = F.lit(True) if level <= depth else F.coalesce("own", F.lit(False))
        rows = save(rows.withColumn("branch", F.when(told, F.col("template")).otherwise(F.col("branch"))).drop("segment", "own"), "level")
    rows = rows.withColumn("tail", F.lit(open_ended))
    for part in ready:
        rows = rows.unionByName(part.withColumn("tail", F.lit(False)))
    tail = F.col("tail") | (F.col("branch") != F.col("template"))
    return rows.withColumn("parent", F.when(tail, F.col("branch")).otherwise(F.col("parent"))) \
        .withColumn("template", F.when(tail, F.concat("branch", F.lit("/**"))).otherwise(F.col("template"))).drop("segments", "branch", "tail")


def judge_templates(rows: DataFrame, sigmas: float = SIGMAS, smoothing: float = SMOOTHING) -> DataFrame:
    """host, template, purity, from rows with host, parent, template, good (null: not labelled)."""
    leaves = save(rows.groupBy("host", "parent", "template").agg(F.count("good").alias("m"), F.coalesce(F.sum("good"), F.lit(0)).alias("g")), "leaves")
    hosts = leaves.groupBy("host").agg(F.sum("m").alias("host_m"), F.sum("g").alias("host_g"))
    overall = leaves.agg(((F.sum("g") + 1) / (F.sum("m") + 2)).alias("overall"))
    share = (F.col("host_g") + smoothing * F.lit(overall.first()[0])) / (F.col("host_m") + smoothing)
    parents = leaves.groupBy("host", "parent").agg(F.sum("m").alias("parent_m"), F.sum("g").alias("parent_g"))
    known = leaves.join(parents, ["host", "parent"]).join(hosts.select("host", share.alias("h")), "host")
    p = F.try_divide(F.col("parent_g"), F.col("parent_m"))
    own = F.col("m").cast("double")
    unlike = (F.col("m") > 0) & (F.abs(F.col("g") - p * own) >= sigmas * F.sqrt(p * (1 - p) * own)) & (p > 0) & (p < 1)
    known = known.withColumn("group", F.when(F.coalesce(unlike, F.lit(False)), F.col("template")).otherwise(F.lit("")))
    groups = known.groupBy("host", "parent", "group", "h").agg(F.sum("m").alias("M"), F.sum("g").alias("G"))
    judged = groups.select("host", "parent", "group", ((F.col("G") + smoothing * F.col("h")) / (F.col("M") + smoothing)).alias("purity"))
    return known.join(judged, ["host", "parent", "group"]).select("host", "template", "purity")


def filter_pages(pages: DataFrame, labels: DataFrame, rules=RULES, purity: float = PURITY) -> DataFrame:
    """page_id, host, path, rule, verdict, template of every page."""
    host, path = split_url(F.col("url"))
    slim = pages.select("page_id", host.alias("host"), path.alias("path"))
    good = labels.where("doc_id is not null and quality is not null and toxic is not null").groupBy("doc_id").agg(
        F.min(((F.col("quality") == 1) & (F.col("toxic") == 0)).cast("int")).alias("good"))
    slim = slim.join(good, F.col("page_id").cast("long") == good["doc_id"].cast("long"), "left").drop("doc_id")
    rows = save(grow_templates(slim), "templates")
    rejected = judge_templates(rows).where(F.col("purity") < purity).select("host", "template", F.lit("block").alias("judged"))
    rule, verdict = apply_rules(F.col("host"), F.col("path"), rules)
    judged = rows.join(rejected, ["host", "template"], "left")
    return judged.select("page_id", "host", "path", rule.alias("rule"),
                         F.coalesce(verdict, F.col("judged"), F.lit("allow")).alias("verdict"), "template")


def oracle_sql(depth: int = DEPTH) -> str:
    """The same rows as DuckDB SQL over ``pages`` and ``labels``."""
    levels = []
    for k in range(1, depth + 1):
        levels.append(f"""
    c{k} AS (SELECT host, template, segments[{k}] AS segment, count(*) AS n FROM r{k - 1} WHERE len(segments) >= {k} GROUP BY ALL),
    k{k} AS (SELECT host, template, segment FROM c{k} WHERE n >= {MIN_ROWS}),
    r{k} AS MATERIALIZED (SELECT r.page_id, r.host, r.path, r.good, r.segments,
             CASE WHEN len(r.segments) >= {k} THEN r.template ELSE r.parent END AS parent,
             CASE WHEN len(r.segments) < {k} THEN r.template WHEN k.segment IS NULL THEN r.template || '/*'
                  ELSE r.template || '/' || k.segment END AS template
             FROM r{k - 1} r LEFT JOIN k{k} k ON k.host = r.host AND k.template = r.template
                  AND len(r.segments) >= {k} AND k.segment = r.segments[{k}]),""")
    fits = [(r, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')", h + p) for r, h, p in RULES]
    fits.sort(key=lambda f: -len(f[2]))
    cases = [" ".join(f"WHEN {fit} THEN '{(name, decision)[i]}'" for decision, fit, name in fits) for i in (0, 1)]
    return f"""
    WITH l AS (SELECT doc_id, min(CAST(quality = 1 AND toxic = 0 AS INT)) AS good FROM labels
               WHERE quality IS NOT NULL AND toxic IS NOT NULL GROUP BY doc_id),
    u AS (SELECT page_id, lower(coalesce(regexp_extract(url, '{_PARTS}', 1), '')) AS host,
                 coalesce(regexp_extract(url, '{_PARTS}', 2), '') AS path FROM pages),
    r0 AS MATERIALIZED (SELECT page_id, host, path, good, '' AS parent, '' AS template,
                 CASE WHEN path = '' THEN [] ELSE string_split(path[2:], '/') END AS segments
          FROM u LEFT JOIN l ON l.doc_id = u.page_id),{''.join(levels)}
    t AS MATERIALIZED (SELECT page_id, host, path, good, CASE WHEN len(segments) > {depth} THEN template ELSE parent END AS parent,
                 CASE WHEN len(segments) > {depth} THEN template || '/**' ELSE template END AS template FROM r{depth}),
    leaf AS (SELECT host, parent, template, count(good) AS m, coalesce(sum(good), 0) AS g FROM t GROUP BY ALL),
    known AS (SELECT *, sum(m) OVER (PARTITION BY host, parent) AS pm, sum(g) OVER (PARTITION BY host, parent) AS pg,
                 (sum(g) OVER (PARTITION BY host) + {SMOOTHING} * (SELECT (sum(g) + 1) / (sum(m) + 2) FROM leaf))
                 / (sum(m) OVER (PARTITION BY host) + {SMOOTHING}) AS h FROM leaf),
    grouped AS (SELECT *, CASE WHEN m > 0 AND pg > 0 AND pg < pm AND abs(g - pg / pm * m) >= {SIGMAS} * sqrt(pg / pm * (1 - pg / pm) * m)
                 THEN template ELSE '' END AS grp FROM known),
    judged AS (SELECT host, template, (sum(g) OVER w + {SMOOTHING} * h) / (sum(m) OVER w + {SMOOTHING}) AS purity
               FROM grouped WINDOW w AS (PARTITION BY host, parent, grp))
    SELECT page_id, host, path, CASE {cases[0]} END AS rule,
           coalesce(CASE {cases[1]} END, CASE WHEN purity < {PURITY} THEN 'block' ELSE 'allow' END) AS verdict, template
    FROM t JOIN judged USING (host, template)"""
