"""URL filter: rules, then a path-template tree per host judged by labelled purity.

Explicit rules come first: a rule ``host/path-prefix`` fits its host, all
subdomains, and paths that start with its prefix; the longest fitting rule wins.

Every other url is judged by its template. Paths are cut into segments. Digit
runs and hex keys become shapes, but a segment with ``min_labels`` labels whose share of
good ones differs from that of the other segments of its shape stays as it is
(``/forum1/`` good, ``/forum2/`` bad). Then, level by level down the tree of
each host, the segments below a node that are too many and too rare turn into a
wildcard, so their subtrees are pooled before the next level is looked at. A rare
segment with ``min_labels`` labels stays if its share of good labels differs
(two-proportion test) from the rest below the node, or from the segments with fewer.
Sibling branches whose labelled shares do not differ (two-proportion test against
a group's pooled counts, best-labelled branches first) merge too. A template's purity is its share of good labels,
smoothed towards its host's share, which is smoothed towards the overall one;
templates below ``min_purity`` are rejected.

All counts are partial aggregates over distinct (host, shape) paths, so a host
with a third of all rows costs one row per shape. Paths are followed to their last
segment; a node that holds one path is finished, so a long path of its own costs
no levels. Defined cases: a url that is
null or without ``://`` has empty host and path; a url of any length is used whole;
pages without labels anywhere get the prior 1 (allow);
duplicate pages count as often as they occur; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assetrank.llm import tables

Rule = tuple[str, str]

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def host_and_path(url: Column) -> tuple[Column, Column]:
    part = lambda k: F.coalesce(F.regexp_extract(url, _PARTS, k), F.lit(""))
    return ascii_lower(part(1)), part(2)


def longest_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):  # later, longer rules override
        at = text.index("/")
        fits = ((host == text[:at]) | host.endswith("." + text[:at])) & path.startswith(text[at:])
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def segments(path: Column) -> Column:
    return F.filter(F.split(path, "/+"), lambda s: s != "")


def shape_of(segment: Column) -> Column:
    """A segment with long hex keys as ``%`` and digit runs as ``#``."""
    return F.regexp_replace(F.regexp_replace(segment, r"(?i)\b(?=[a-z-]*[0-9])[0-9a-f-]{12,}\b", "%"), "[0-9]+", "#")


def with_shapes(rows: DataFrame, marked: DataFrame, min_labels: int, z: float) -> DataFrame:
    """``rows`` (page_id, host, path) with ``shape``: the path's segments as shapes, but
    literal where labels tell a segment from the others of its shape.

    Only labelled paths are looked at, and of them only the levels where some literal
    segment has enough labels.
    """
    rows = rows.withColumn("raw", segments(F.col("path"))).withColumn("shape", F.transform("raw", shape_of))
    judged = rows.join(marked, "page_id").groupBy("host", "raw", "shape").agg(F.sum("good").alias("good"), F.count("*").alias("labels"))
    judged = tables.stored(judged, "labelled")
    each = judged.select("host", "labels", F.posexplode(F.arrays_zip("raw", "shape")).alias("level", "s")).where("s.raw <> s.shape")
    levels = each.groupBy("host", "level", "s.raw").agg(F.sum("labels").alias("n")).where(F.col("n") >= min_labels).select("level").distinct()
    for level in sorted(r["level"] for r in levels.collect()):  # as many as a path has segments
        here = judged.where(F.size("raw") > level).withColumns({"before": F.slice("shape", 1, level), "seg": F.get("raw", F.lit(level)), "kind": F.get("shape", F.lit(level))})
        own = here.groupBy("host", "before", "kind", "seg").agg(F.sum("good").alias("g"), F.sum("labels").alias("n"))
        alike = own.groupBy("host", "before", "kind").agg(F.sum("g").alias("all_g"), F.sum("n").alias("all_n"))
        own = own.where((F.col("seg") != F.col("kind")) & (F.col("n") >= min_labels)).join(alike, ["host", "before", "kind"])
        apart = differs(F.col("g"), F.col("n"), F.col("all_g") - F.col("g"), F.col("all_n") - F.col("n"), z)
        kept = tables.stored(own.where(apart).select(F.col("host").alias("kept_host"), F.col("before").alias("kept_before"), F.col("seg").alias("kept_seg")), f"literal-{level}")
        if kept.isEmpty():
            continue
        size = kept.agg(F.sum(F.octet_length("kept_host") + F.octet_length("kept_seg") + F.octet_length(F.concat_ws("/", "kept_before")) + 64)).first()[0]

        def with_literals(df: DataFrame, level: int = level, kept: DataFrame = tables.small_side(kept, 1, size)) -> DataFrame:
            same = (F.col("host") == F.col("kept_host")) & (F.slice("shape", 1, level) == F.col("kept_before")) & (F.get("raw", F.lit(level)) == F.col("kept_seg"))
            literal = F.concat(F.slice("shape", 1, level), F.array("kept_seg"), F.slice("shape", level + 2, 1 << 30))
            return df.join(kept, same, "left").withColumn("shape", F.when(F.col("kept_seg").isNotNull(), literal).otherwise(F.col("shape"))).drop(*kept.columns)

        rows, judged = with_literals(rows), with_literals(judged)
    return rows.drop("raw")


def differs(good: Column, n: Column, other_good: Column, other_n: Column, z: float) -> Column:
    """Two-proportion test; without labels on both sides nothing differs."""
    pooled = F.try_divide(good + other_good, n + other_n)
    spread = F.sqrt(F.greatest(pooled * (1 - pooled), F.lit(0.0)) * (F.try_divide(F.lit(1.0), n) + F.try_divide(F.lit(1.0), other_n)))
    return F.coalesce(F.abs(F.try_divide(good, n) - F.try_divide(other_good, other_n)) > z * spread, F.lit(False))


def template_tree(paths: DataFrame, max_children: int, min_share: float, min_labels: int, z: float) -> DataFrame:
    """Templates of distinct paths (host, shape, n, good, bad): adds ``template``
    (generalised) and ``merged`` (after branches were merged)."""
    paths = paths.withColumn("template", F.array().cast("array<string>"))
    finished, level = [], 0
    while True:
        # a node with one path is finished: its segments have no siblings
        alone = paths.groupBy("host", "template").agg(F.count("*").alias("paths")).where("paths = 1").drop("paths").withColumn("alone", F.lit(True))
        at = paths.join(alone, ["host", "template"], "left").withColumn("alone", F.coalesce("alone", F.lit(False)))
        at = at.withColumn("seg", F.when(~F.col("alone"), F.get("shape", F.lit(level))))
        child = at.where("seg is not null").groupBy("host", "template", "seg").agg(
            F.sum("n").alias("child_n"), F.sum("good").alias("g"), F.sum(F.col("good") + F.col("bad")).alias("l")
        )
        few = F.col("l") < min_labels
        node = child.groupBy("host", "template").agg(
            F.count("*").alias("children"),
            F.sum("child_n").alias("node_n"),
            *(F.sum(c).alias(f"node_{c}") for c in ("g", "l")),
            *(F.sum(F.when(few, F.col(c)).otherwise(0)).alias(f"few_{c}") for c in ("g", "l")),
        )
        g, l = F.col("g"), F.col("l")
        apart = differs(g, l, F.col("node_g") - g, F.col("node_l") - l, z) | differs(g, l, F.col("few_g"), F.col("few_l"), z)
        rare = child.join(node, ["host", "template"]).where(
            (F.col("children") > max_children) & (F.col("child_n") < F.col("node_n") * min_share) & (few | ~apart)
        )
        rare = rare.select("host", "template", "seg", F.lit(True).alias("wild"))
        at = at.join(rare, ["host", "template", "seg"], "left")
        step = F.when(F.col("alone"), F.concat("template", F.slice("shape", level + 1, 1 << 30))).when(F.col("seg").isNull(), F.col("template"))
        step = step.otherwise(F.concat("template", F.array(F.when(F.col("wild"), F.lit("*")).otherwise(F.col("seg")))))
        at = at.withColumns({"template": step, "done": F.col("seg").isNull()}).drop("seg", "wild", "alone")
        at = tables.stored(at, f"paths-{level}")
        finished.append(at.where("done").drop("done"))
        paths = at.where("NOT done").drop("done")
        if paths.isEmpty():
            break
        level += 1
    paths = finished[0]
    for more in finished[1:]:
        paths = paths.union(more.select(*paths.columns))
    merged = paths.groupBy("host", "template").agg(*(F.sum(c).alias(c) for c in ("n", "good", "bad")))
    merged = merged.withColumn("merged", F.col("template"))
    for level in reversed(range(level)):  # deeper down no node has two paths
        merged = tables.stored(_merge_branches(merged, level, z), f"merged-{level}")  # a level joins its input twice
    return paths.join(merged.select("host", "template", "merged"), ["host", "template"])


def groups_of(branches: list[tuple[str, int, int]], z: float) -> list[list[str]]:
    """Groups of sibling branches (name, good, labels) whose labelled shares do not differ.

    The best-labelled come first; each joins the nearest group from whose pooled
    counts it does not differ, or begins one. So a branch of few labels joins one
    group and links none. Branches without labels say nothing: with more than one
    group they form their own, which the host's share judges.
    """
    groups: list[tuple[list[str], int, int]] = []
    for name, good, n in sorted((b for b in branches if b[2]), key=lambda b: (-b[2], b[0])):
        near = []
        for k, (_, g0, n0) in enumerate(groups):
            pooled = (good + g0) / (n + n0)
            apart = abs(good / n - g0 / n0)
            if apart <= z * math.sqrt(pooled * (1 - pooled) * (1 / n + 1 / n0)):
                near.append((apart, k))
        if near:
            k = min(near)[1]
            names, g0, n0 = groups[k]
            names.append(name)
            groups[k] = (names, g0 + good, n0 + n)
        else:
            groups.append(([name], good, n))
    out = [names for names, _, _ in groups]
    rest = [name for name, _, n in branches if not n]
    if rest and len(out) == 1:
        out[0] += rest
    elif rest:
        out.append(rest)
    return [sorted(names) for names in out]


def group_label(names: list[str], siblings: int, most: int = 20) -> str:
    """``*`` for the whole family, else ``{a|b}``; the first names and the number of the others tell a large group."""
    if len(names) == 1:
        return names[0]
    if len(names) == siblings:
        return "*"
    return "{" + "|".join(names[:most] + [f"+{len(names) - most}"] * (len(names) > most)) + "}"


def _merge_branches(nodes: DataFrame, level: int, z: float) -> DataFrame:
    """Merge sibling branches at a level whose labelled shares do not differ (``groups_of``).

    A family is what the tree kept literal below one node: one row here.
    """
    seg = F.get("merged", F.lit(level))
    nodes = nodes.withColumn("before", F.slice("merged", 1, level)).withColumn("branch", seg)
    nodes = nodes.withColumn("after", F.when(seg.isNotNull(), F.slice("merged", level + 2, 1 << 20)))
    family = ["host", "before", "after"]
    branches = nodes.where("branch IS NOT NULL").groupBy(*family, "branch").agg(F.sum("good").alias("g"), F.sum(F.col("good") + F.col("bad")).alias("n"))
    families = branches.groupBy(*family).agg(F.collect_list(F.struct("branch", "g", "n")).alias("all")).where(F.size("all") > 1)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tables.each(batches):
            rows = []
            for all_ in batch.column(0).to_pylist():
                groups = groups_of([(b["branch"], b["g"], b["n"]) for b in all_], z)
                label = {name: group_label(names, len(all_)) for names in groups for name in names}
                rows.append([label[b["branch"]] for b in all_])
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], batch.column(0), pa.array(rows, pa.list_(pa.string()))], names=[*family, "all", "labels"])

    tables.ship(nodes.sparkSession)
    schema = "host string, before array<string>, after array<string>, all array<struct<branch: string, g: bigint, n: bigint>>, labels array<string>"
    pairs = families.select("all", *family).mapInArrow(labelled, schema).select(*family, F.explode(F.arrays_zip("all.branch", "labels")).alias("pair"))
    labels = pairs.select(*family, F.col("pair.branch").alias("branch"), F.col("pair.labels").alias("label"))
    merged = F.when(F.col("label").isNull(), F.col("merged")).otherwise(F.concat("before", F.array("label"), "after"))
    return nodes.join(labels, [*family, "branch"], "left").select("host", "template", "n", "good", "bad", merged.alias("merged"))


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[Rule],
    max_children: int = 20,
    min_share: float = 0.02,
    z: float = 2.58,
    prior_weight: float = 10.0,
    min_purity: float = 0.5,
    min_labels: int = 10,
) -> DataFrame:
    """Judge every row of ``pages`` (page_id, url).

    ``labels`` has page_id and ``good`` (1 or 0) for some pages. Result: page_id,
    url, host, path, rule, template, purity, verdict.
    """
    url = F.col("url").cast("string")
    host, path = host_and_path(url)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), url.alias("url"), host.alias("host"), path.alias("path"))
    marked = tables.stored(labels.where("good is not null").groupBy(F.col("page_id").cast("long").alias("page_id")).agg(F.min("good").alias("good")), "marked")
    rows = with_shapes(rows, marked, min_labels, z)
    paths = (
        rows.join(marked, "page_id", "left")
        .groupBy("host", "shape")
        .agg(F.count("*").alias("n"), F.count_if(F.col("good") == 1).alias("good"), F.count_if(F.col("good") == 0).alias("bad"))
    )
    paths = tables.stored(paths, "paths")
    tree = template_tree(paths, max_children, min_share, min_labels, z)

    overall = paths.agg(F.coalesce(F.try_divide(F.sum("good"), F.sum(F.col("good") + F.col("bad"))), F.lit(1.0)).alias("prior")).first()[0]
    smooth = lambda good, n, prior: (good + prior_weight * prior) / (n + prior_weight)
    hosts = paths.groupBy("host").agg(smooth(F.sum("good"), F.sum(F.col("good") + F.col("bad")), F.lit(overall)).alias("host_share"))
    pure = tree.groupBy("host", "merged").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).join(hosts, "host")
    pure = pure.withColumn("purity", smooth(F.col("good"), F.col("good") + F.col("bad"), F.col("host_share")))
    judged = tree.select("host", "shape", "merged").join(pure.select("host", "merged", "purity"), ["host", "merged"])
    judged = tables.stored(judged.select("host", "shape", F.concat(F.lit("/"), F.concat_ws("/", "merged")).alias("template"), "purity"), "templates")

    rule, ruled = longest_rule(rules, F.col("host"), F.col("path"))
    size = judged.agg(F.sum(F.octet_length("host") + 2 * F.octet_length("template") + 64)).first()[0] or 0
    found = rows.join(tables.small_side(judged, 1, size), ["host", "shape"])
    by_method = F.when(F.col("purity") < min_purity, F.lit("block")).otherwise(F.lit("allow"))
    return found.select("page_id", "url", "host", "path", rule.alias("rule"), "template", "purity", F.coalesce(ruled, by_method).alias("verdict"))
