"""Scans for private strings, and inventories of files."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafpress.operators.literals import bounded, first_places


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str


#: Letters, digits of any script and the underscore; written out, since what ``\\w`` and ``\\b`` mean differs between engines and versions.
_W = r"\p{L}\p{N}_"
#: What must not stand in a released text; fixed patterns.
RULES = (
    Rule("drive path", r"(?<![A-Za-z0-9:/])[A-Za-z]:[\\/]"),
    Rule("temp root", r"(?i)[A-Za-z]:\\[^\"'\n]*system-temp"),
    # \b[\w.+-]+@[\w-]+\.[a-z]{2,}\b, tried once a run of such characters: long runs cost time in proportion
    Rule("e-mail", rf"(?i)(?<![{_W}.+-])[.+-]*+[{_W}][{_W}.+-]*+@[{_W}-]++\.[a-z]{{2,}}(?![{_W}])"),
    Rule("token", rf"(?<![{_W}])(?:sk-[A-Za-z0-9]{{16,}}|gh[pous]_[A-Za-z0-9]{{20,}})(?![{_W}])"),
)
#: Lines that define rules may hold what the rules look for.
DEFINITION = r"re\.compile\("
#: Files that do not enter a release, the first match giving the reason; fixed values.
EXCLUDED = (("**/.git/**", "repository internals"), ("**/__pycache__/**", "byte code"), ("**/*.pyc", "byte code"), ("**/out/**", "run products"), ("**/scratch/**", "scratch"), ("**/*.local.txt", "local rules"))
LIGHT = (("**/vectors_*.npy", "vectors left out"), ("**/ids_*.json", "vector ids left out"))
#: Release layers by path prefix; fixed values.
LAYERS = (("00-engine", ("SKILL.md", "scripts/", "templates/")), ("10-references", ("references/",)), ("20-examples", ("examples/",)))
OTHER_LAYER = "90-other"


def _line_at(text: str, position: Column) -> Column:
    """Line from 1 of a position from 1."""
    head = F.substring(F.col(text), F.lit(1), position - 1)
    return F.length(head) - F.length(F.replace(head, F.lit("\n"), F.lit(""))) + 1


def scan_patterns(docs: DataFrame, path: str = "path", text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, label, line, on_definition): each rule's first match in a text.  What matched is never shown.

    All rules run in one projection; only hits become rows.  Null text has none.
    """
    at = [F.regexp_instr(text, F.lit(r.pattern)) for r in rules]
    hits = F.filter(F.array(*(F.struct(F.lit(r.label).alias("label"), a.alias("at")) for r, a in zip(rules, at, strict=True))), lambda h: h["at"] > 0)
    rows = docs.select(path, text, F.explode(hits).alias("h")).withColumn("line", _line_at(text, F.col("h.at")))
    return rows.select(path, "h.label", "line", F.get(F.split(text, "\n"), F.col("line") - 1).rlike(DEFINITION).alias("on_definition"))


def scan_literals(docs: DataFrame, literals: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """(path, literal_id, line): first line of each forbidden literal (literal_id, literal) in a text, in one pass for any number of literals.

    Null texts and literals have no hits; an empty literal is on line 1 of every text; a literal that stands in several rows hits for each.
    """
    found = literals.select("literal_id", "literal").where("literal is not null")
    first = first_places(docs.select(path, F.col(text).alias("__text")), [r[0] for r in bounded(found.select("literal").distinct())], "__text")
    rows = first.select(path, "literal", _line_at("__text", F.col("at")).alias("line"))
    return rows.join(F.broadcast(found), "literal").select(path, "literal_id", "line")


def apply_exemptions(hits: DataFrame, exempt: DataFrame, path: str = "path") -> DataFrame:
    """Add ``exemption``: the reason a path (path, reason) is exempt, or ``rule definition``; null if the hit counts."""
    rows = hits.join(exempt.selectExpr(path, "reason as exemption"), path, "left")
    return rows.withColumn("exemption", F.coalesce("exemption", F.when(F.col("on_definition"), "rule definition")))


def audit_verdict(docs: DataFrame, hits: DataFrame, path: str = "path", have_literals: bool = True) -> DataFrame:
    """Per document: FAIL with its labels, else PASS; SKIP instead of PASS when there is no table of literals."""
    labels = hits.where("exemption is null").groupBy(path).agg(F.array_join(F.sort_array(F.collect_list(F.concat("label", F.lit("@L"), F.col("line").cast("string")))), "; ").alias("labels"))
    rows = docs.select(path).join(labels, path, "left")
    return rows.select(path, F.when(F.col("labels").isNotNull(), "FAIL").otherwise("PASS" if have_literals else "SKIP").alias("verdict"), F.coalesce("labels", F.lit("")).alias("labels"))


def glob_pattern(glob: str) -> str:
    """A regular expression for a path glob; ``**/`` may be nothing."""
    out = ""
    for part in re.split(r"(\*\*/|\*\*|\*|\?)", glob):
        out += {"**/": "(?:.*/)?", "**": ".*", "*": "[^/]*", "?": "[^/]"}.get(part, re.sub(r"([.^$+(){}\[\]|\\])", r"\\\1", part))
    return f"^{out}$"


def classify_files(files: DataFrame, rules: tuple[tuple[str, str], ...] = EXCLUDED, light: bool = False, path: str = "path") -> DataFrame:
    """Add ``reason``: that of the first rule that matches the path, null for files that stay."""
    chosen = (*rules, *(LIGHT if light else ()))
    return files.withColumn("reason", F.coalesce(*(F.when(F.col(path).rlike(glob_pattern(g)), r) for g, r in chosen)))


def assign_layer(files: DataFrame, layers: tuple[tuple[str, tuple[str, ...]], ...] = LAYERS, path: str = "path") -> DataFrame:
    return files.withColumn("layer", F.coalesce(*(F.when(F.col(path).startswith(p), name) for name, prefixes in layers for p in prefixes), F.lit(OTHER_LAYER)))


def manifest(files: DataFrame) -> DataFrame:
    return files.select("path", "layer", "bytes", "sha256")


def layer_summary(rows: DataFrame) -> DataFrame:
    return rows.groupBy("layer").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def layer_digests(rows: DataFrame) -> DataFrame:
    """(layer, sha256): a digest of the paths, sizes and digests of a layer's files.

    Files are dealt to 4096 parts by a digest of their path; a part's lines are put in order of path and digested, then the
    parts' digests in order.  So no group holds a whole layer, and the outcome does not depend on how rows are dealt.
    """
    line = F.concat_ws("\t", "path", F.col("bytes").cast("string"), "sha256")
    parts = rows.groupBy("layer", F.substring(F.sha2("path", 256), 1, 3).alias("part")).agg(F.sha2(F.array_join(F.sort_array(F.collect_list(line)), "\n"), 256).alias("digest"))
    whole = F.array_join(F.sort_array(F.collect_list(F.concat("part", "digest"))), "")
    return parts.groupBy("layer").agg(F.sha2(whole, 256).alias("sha256"))


def verify_layers(rows: DataFrame, recorded: DataFrame) -> DataFrame:
    """(layer, state) of present files against recorded (layer, sha256): ok, bad, missing or extra."""
    both = recorded.selectExpr("layer", "sha256 as s1").join(layer_digests(rows).selectExpr("layer", "sha256 as s2"), "layer", "full")
    return both.select("layer", F.expr("case when s2 is null then 'missing' when s1 is null then 'extra' when s1 = s2 then 'ok' else 'bad' end").alias("state"))


def excluded_summary(files: DataFrame, path: str = "path") -> DataFrame:
    """Count and three smallest paths of each reason; the smallest are kept while counting, never all paths."""
    nth = F.row_number().over(Window.partitionBy("reason").orderBy(path))
    few = files.where("reason is not null").withColumn("nth", nth).where("nth <= 3").groupBy("reason").agg(F.sort_array(F.collect_list(path)).alias("examples"))
    return files.where("reason is not null").groupBy("reason").agg(F.count("*").alias("files")).join(few, "reason")


def verify_manifest(files: DataFrame, recorded: DataFrame) -> DataFrame:
    """(path, state): ok, bad (size or digest differs), missing or extra."""
    a = recorded.selectExpr("path", "bytes as b1", "sha256 as s1")
    b = files.selectExpr("path", "bytes as b2", "sha256 as s2")
    state = F.when(F.col("s2").isNull(), "missing").when(F.col("s1").isNull(), "extra").when((F.col("b1") == F.col("b2")) & (F.col("s1") == F.col("s2")), "ok").otherwise("bad")
    return a.join(b, "path", "full").select("path", state.alias("state"))
