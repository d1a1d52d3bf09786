"""Ordered rewriting of texts with counts: literal folds, context gates and regular expressions.

Small literal rule sets fold inside the JVM.  Rules with gates on each match, or many of them,
run in one vectorised pass over the texts with the rules broadcast; one projection a rule would
make the plan as deep as the rule table.  There an automaton finds the literal rules that can fire
(operators/fold.py), so time does not grow with the rules.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions.text import around, changed_chars, contains_any, is_srt_text, let, occurrences
from lectern.operators.fold import Ordered, fold_many, usage

#: Characters on either side of a match that a context may use; the match itself is part of it.
WINDOW = 120
#: Up to so many literal rules fold inside the JVM, where each costs a scan of every text.
FEW_RULES = 32
_WORD = re.compile("[가-힣A-Za-z0-9]")
_SHORT = re.compile("[가-힣]{1,4}")
STATS = "array<struct<stage:string,ord:long,wrong:string,right:string,applied:long,skipped:long>>"


def fold_literals(text: Column, rules: list[tuple[str, str]]) -> Column:
    """struct(text, counts): the rules applied one after the other; counts[i] is of rule i.

    Each rule sees what the rules before it left.
    """
    table = F.array(*(F.struct(F.lit(w).alias("wrong"), F.lit(r).alias("right")) for w, r in rules))
    start = F.struct(text.alias("text"), F.array().cast("array<bigint>").alias("counts"))
    step = lambda a, r: F.struct(F.replace(a["text"], r["wrong"], r["right"]).alias("text"), F.array_append(a["counts"], occurrences(a["text"], r["wrong"])).alias("counts"))
    return F.aggregate(table, start, step) if rules else start


def fold_lines(lines: DataFrame, rules: list[tuple[str, str]], text_col: str = "text") -> DataFrame:
    """Lines with the rules applied longest first; adds uses, an array of (ord, n) of rules in that order.

    Only text lines of subtitles change: a column is_srt marks the files.
    """
    ordered = by_length(rules)
    text = F.col(text_col)
    able = ~F.col("is_srt") | is_srt_text(text) if "is_srt" in lines.columns else F.lit(True)
    if len(ordered) > FEW_RULES:
        return fold_many(lines.withColumn("__able", able), _ranked(lines, ordered), text_col, "__able").drop("__able")
    done = F.when(able, fold_literals(text, ordered)).otherwise(fold_literals(text, []))
    uses = F.filter(F.transform("__f.counts", lambda n, i: F.struct(i.cast("long").alias("ord"), n.alias("n"))), lambda u: u["n"] > 0)
    return lines.withColumn("__f", done).withColumn("uses", uses).withColumn(text_col, F.col("__f.text")).drop("__f")


def by_length(rules: Iterable[tuple[str, str]]) -> list[tuple[str, str]]:
    """Rules with something to look for, longest first; equal lengths keep their order."""
    return sorted((r for r in rules if r[0]), key=lambda r: -len(r[0]))


def _ranked(table: DataFrame, ordered: list[tuple[str, str]]) -> DataFrame:
    return table.sparkSession.createDataFrame([(i, w, r) for i, (w, r) in enumerate(ordered)], "ord long, wrong string, right string")


def rule_usage(folded: DataFrame, rules: list[tuple[str, str]]) -> DataFrame:
    """(wrong, right, uses) over all lines of fold_lines(), for rules that were used."""
    return usage(folded, _ranked(folded, by_length(rules)))


def gated_replace(text: Column, wrong: str, right: str, include: Iterable[str] = (), exclude: Iterable[str] = (), window: int = WINDOW) -> Column:
    """struct(text, applied, skipped) for one literal rule whose every match is gated by its context."""
    none = F.array().cast("array<string>")
    words = lambda ws: F.array(*map(F.lit, ws)) if ws else none
    include, exclude = tuple(include), tuple(exclude)
    size = len(wrong)

    def whole(p: Column) -> Column:
        n = F.size(p) - 1
        starts = F.aggregate(F.slice(p, 1, n), F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")), lambda a, x: F.struct((a["at"] + F.length(x) + size).alias("at"), F.array_append(a["out"], a["at"] + F.length(x)).alias("out")), lambda a: a["out"])

        def allowed(s: Column) -> Column:
            near = around(text, s, s + size, window)
            yes = contains_any(near, words(include)) if include else F.lit(True)
            return yes & ~contains_any(near, words(exclude)) if exclude else yes

        def joined(ok: Column) -> Column:
            applied = F.size(F.filter(ok, lambda x: x))
            parts = F.zip_with(ok, F.slice(p, 2, n), lambda o, x: F.concat(F.when(o, right).otherwise(wrong), x))
            return F.struct(F.concat(p[0], F.array_join(parts, "")).alias("text"), applied.cast("long").alias("applied"), (n - applied).cast("long").alias("skipped"))

        return let(F.transform(starts, allowed), joined)

    same = F.struct(text.alias("text"), F.lit(0).cast("long").alias("applied"), F.lit(0).cast("long").alias("skipped"))
    return F.when(F.contains(text, F.lit(wrong)), let(F.split(text, re.escape(wrong), -1), whole)).otherwise(same)


@dataclass(frozen=True)
class RegexRule:
    """A pattern with its replacement (\\1 for groups), the labels that it counts under, and its gates."""

    pattern: str
    replacement: str
    wrong: str
    right: str
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()


@dataclass(frozen=True)
class FamilyRule:
    """A pattern whose match begins with a stem to be replaced, and what holds it back."""

    pattern: str
    wrong: str
    right: str
    skip_suffixes: tuple[str, ...] = ()
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    compound_prefixes: tuple[str, ...] | None = None
    reject_near: str | None = None
    reject_window: int = 24
    follow: str | None = None


@dataclass(frozen=True)
class Rules:
    """All that a topic's rewriting needs; every table is a parameter."""

    literals: tuple[tuple[str, str], ...] = ()
    bases: dict[tuple[str, str], tuple[str, str]] = field(default_factory=dict)
    forced: frozenset[tuple[str, str]] = frozenset()
    raw_priority: frozenset[tuple[str, str]] = frozenset()
    domain_keywords: tuple[str, ...] = ()
    pair_include: dict[tuple[str, str], tuple[str, ...]] = field(default_factory=dict)
    pair_exclude: dict[tuple[str, str], tuple[str, ...]] = field(default_factory=dict)
    contextual: tuple[RegexRule, ...] = ()
    families: tuple[FamilyRule, ...] = ()
    compounds: tuple[tuple[str, str], ...] = ()
    regexes: tuple[RegexRule, ...] = ()
    stable: tuple[tuple[str, str], ...] = ()
    stable_regexes: tuple[tuple[str, str], ...] = ()
    topic_rules: bool = True


def _near(text: str, start: int, end: int, words: Iterable[str], window: int = WINDOW) -> bool:
    part = text[max(0, start - window) : end + window]
    return any(w in part for w in words)


def _touches_word(text: str, start: int, end: int) -> bool:
    return bool(start and _WORD.match(text[start - 1]) or end < len(text) and _WORD.match(text[end]))


def _passes(rules: Rules, pair, text: str, start: int, end: int, is_raw: bool) -> bool:
    """The gates of a literal match, in order of priority."""
    if pair in rules.forced:
        return True
    if rules.topic_rules and rules.raw_priority and rules.bases.get(pair, pair) in rules.raw_priority:
        if is_raw:
            return True
        if not _near(text, start, end, rules.domain_keywords):
            return False
    if (words := rules.pair_exclude.get(pair)) and _near(text, start, end, words):
        return False
    if (words := rules.pair_include.get(pair)) and not _near(text, start, end, words):
        return False
    if len(pair[0]) <= 4 and _SHORT.fullmatch(pair[0]):
        return bool(rules.domain_keywords) and not _touches_word(text, start, end) and _near(text, start, end, rules.domain_keywords)
    return True


def verdict(rules: Rules, pair: tuple[str, str]) -> bool | None:
    """What the gates of a pair say of its every match, or None if its base or the text around may tell."""
    if pair in rules.forced:
        return True
    if rules.topic_rules and rules.raw_priority or rules.pair_exclude.get(pair) or rules.pair_include.get(pair):
        return None
    if len(pair[0]) <= 4 and _SHORT.fullmatch(pair[0]):
        return None if rules.domain_keywords else False
    return True


class _Text:
    """A text under rewriting, and what was counted."""

    def __init__(self, text: str):
        self.text = text
        self.stats: list[tuple] = []

    def count(self, stage: str, wrong: str, right: str, applied: int, skipped: int = 0) -> None:
        if applied or skipped:
            self.stats.append((stage, len(self.stats), wrong, right, applied, skipped))

    def literal(self, stage: str, wrong: str, right: str) -> None:
        n = self.text.count(wrong)
        self.text = self.text.replace(wrong, right)
        self.count(stage, wrong, right, n)

    def gated(self, stage: str, pattern: str, replace, allowed, tally: dict) -> None:
        """Every match sees the text as it was before the rule."""
        before = self.text

        def one(m: re.Match) -> str:
            if not allowed(before, m):
                return m[0]
            new, key = replace(m)
            if key:
                tally[key] = tally.get(key, 0) + 1
            return new

        self.text = re.sub(pattern, one, before)


def _family_allowed(rule: FamilyRule):
    def allowed(text: str, m: re.Match) -> bool:
        start, end = m.span()
        rest = m[0][len(rule.wrong) :]
        if rule.compound_prefixes is not None and start and _WORD.match(text[start - 1]) and not text[:start].endswith(tuple(rule.compound_prefixes)):
            return False
        if rest.startswith(tuple(rule.skip_suffixes)):
            return False
        if _near(text, start, end, rule.exclude):
            return False
        if rule.reject_near and re.search(rule.reject_near, text[max(0, start - rule.reject_window) : end + rule.reject_window]):
            return False
        if rule.follow and not re.match(rule.follow, (rest + text[end : end + rule.reject_window]).lstrip()):
            return False
        return not rule.include or _near(text, start, end, rule.include)

    return allowed


def literal_stages(rules: Rules) -> tuple[Ordered, Ordered]:
    """The rules' pairs and stable literals, made ready once for many texts."""
    return Ordered(rules.literals), Ordered(rules.stable)


def rewrite_text(text: str, rules: Rules, overrides: Iterable[tuple[str, str]] = (), is_raw: bool = False, ready: tuple[Ordered, Ordered] | None = None) -> tuple[str, list[tuple]]:
    """The text after all stages, and (stage, ord, wrong, right, applied, skipped).

    Stages: override, regex (contextual, family, compound and plain ones), pair, stable.
    """
    t = _Text(text)
    pairs, stable = ready or literal_stages(rules)
    for wrong, right in sorted(overrides, key=lambda r: -len(r[0])):
        t.literal("override", wrong, right)
    if rules.topic_rules:
        tally: dict[tuple[str, str], int] = {}
        for r in rules.contextual:
            gate = lambda s, m, r=r: not _near(s, *m.span(), r.exclude) and (not r.include or _near(s, *m.span(), r.include))
            t.gated("regex", r.pattern, lambda m, r=r: (m.expand(r.replacement), (r.wrong, r.right)), gate, tally)
        for f in rules.families:
            swap = lambda m, f=f: (f.right + m[0][len(f.wrong) :], (f"{f.wrong}*", f"{f.right}*") if f.right != f.wrong else None)
            t.gated("regex", f.pattern, swap, _family_allowed(f), tally)
        for pattern, replacement in rules.compounds:
            t.gated("regex", pattern, lambda m, x=replacement: (m.expand(x), (m[0], m.expand(x))), lambda s, m: True, tally)
        for r in rules.regexes:
            t.text, n = re.subn(r.pattern, r.replacement, t.text)
            if n:
                tally[r.wrong, r.right] = tally.get((r.wrong, r.right), 0) + n
        for (wrong, right), n in sorted(tally.items(), key=lambda x: (len(x[0][0]), x[0][0]), reverse=True):
            t.count("regex", wrong, right, n)
    t.text, met = pairs.fold(t.text, lambda i, before, start, end: _passes(rules, rules.literals[i], before, start, end, is_raw))
    for i, applied, skipped in met:
        t.count("pair", *rules.literals[i], applied, skipped)
    if rules.topic_rules:
        t.text, met = stable.fold(t.text)
        for i, applied, _ in met:
            t.count("stable", *rules.stable[i], applied)
        for pattern, right in rules.stable_regexes:
            t.text, n = re.subn(pattern, right, t.text)
            t.count("stable", pattern, right, n)
    return t.text, t.stats


def rewrite(docs: DataFrame, rules: Rules, overrides: list[tuple[str, str, str]] = (), path_col: str = "path", text_col: str = "text", raw_col: str | None = None, keep_going: bool = False) -> DataFrame:
    """(path, text, corrected, stats) of documents; overrides are (regular expression of paths, wrong, right).

    Rules travel by broadcast; each text is rewritten whole, as matches and contexts cross lines.
    With keep_going there are status (done or failed) and message, too: a text whose rewriting
    fails stays as it is, and does not stop others.
    """
    told = docs.sparkSession.sparkContext.broadcast((rules, [(re.compile(p), w, r) for p, w, r in overrides]))
    fields = ("stage", "ord", "wrong", "right", "applied", "skipped")
    names = ["path", "text", "corrected", "stats", *(["status", "message"] if keep_going else [])]

    def rows(batches):
        given, extra = told.value
        ready = literal_stages(given)
        for batch in batches:
            texts, stats, wrong = [], [], []
            for path, text, raw in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = [(w, r) for p, w, r in extra if p.match(path or "")]
                try:
                    new, counted = rewrite_text(text or "", given, own, bool(raw), ready)
                    wrong.append(None)
                except Exception as e:
                    if not keep_going:
                        raise
                    new, counted = text or "", []
                    wrong.append(f"{type(e).__name__}: {e}")
                texts.append(new)
                stats.append([dict(zip(fields, s, strict=True)) for s in counted])
            kind = pa.list_(pa.struct([("stage", pa.string()), ("ord", pa.int64()), ("wrong", pa.string()), ("right", pa.string()), ("applied", pa.int64()), ("skipped", pa.int64())]))
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(stats, kind)]
            if keep_going:
                columns += [pa.array(["failed" if w else "done" for w in wrong], pa.string()), pa.array(wrong, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    raw = F.col(raw_col) if raw_col else F.lit(False)
    return docs.select(F.col(path_col).cast("string").alias("path"), F.col(text_col).alias("text"), raw.alias("raw")).mapInArrow(rows, f"path string, text string, corrected string, stats {STATS}" + ", status string, message string" * keep_going)


def audit(rewritten: DataFrame) -> DataFrame:
    """(path, stage, ord, wrong, right, applied, skipped), a row for each rule that met the text."""
    return rewritten.select("path", F.explode("stats").alias("s")).select("path", "s.*")


def metrics(rewritten: DataFrame) -> DataFrame:
    """Per path: changed characters, and rules and hits applied and skipped by stage group.

    Overrides are counted apart from the rules of the other stages.
    """
    mine = lambda cond: F.filter("stats", cond)
    total = lambda rows, f: F.aggregate(rows, F.lit(0).cast("long"), lambda a, s: a + s[f])
    rules = mine(lambda s: (s["stage"] != "override") & (s["applied"] > 0))
    given = mine(lambda s: s["stage"] == "override")
    held = mine(lambda s: s["skipped"] > 0)
    return rewritten.select(
        "path",
        changed_chars(F.col("text"), F.col("corrected")).alias("changed_chars"),
        F.size(rules).cast("long").alias("applied_rules"),
        total(rules, "applied").alias("applied_hits"),
        F.size(held).cast("long").alias("skipped_rules"),
        total(held, "skipped").alias("skipped_hits"),
        F.size(given).cast("long").alias("override_rules"),
        total(given, "applied").alias("override_hits"),
    )
