"""Dictionary feedback in the order of files: what one file teaches applies from the next file on.

A manual pair that is applied in a file enters the dictionary, and from the following file on its
forms with particles are rules too.  So a file's rules depend on the files before it, but only through
the first file in which each manual pair was applied.  Files are dealt in ranges of their order, and each
range is walked from file to file, with a guess of what the ranges before it taught.  That gives a new guess, until it
stays.  The first range is right at once, and each round makes at least one more right, so the guess that
stays is what a walk over all files finds.  Most of what there is to learn is learnt early, so few rounds change
a guess, and of a round that did, only the ranges after the first such place are walked again.

Tables that grow with the dictionary alone travel by broadcast; of the texts only the first place of
each manual pair comes back.  Texts are folded by their pieces (fold.Pieces), of which most come again, and a walk that looks
for lessons rewrites only the files in which a pair may be applied that its range has not shown yet.
"""

from __future__ import annotations

import uuid
from dataclasses import replace
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions.particles import expand_pairs, forms_of
from lectern.functions.text import is_auto_pair
from lectern.operators.dictionary import first_by
from lectern.operators.fold import Ordered, Pieces
from lectern.operators.rewrite import STATS, Rules, rewrite_text, verdict
from lectern.sources.files import work_folder

Pair = tuple[str, str]


class Lessons(NamedTuple):
    """What rules can come from: forms of the dictionary's pairs and manual pairs in order, and forms of what may be taught."""

    known: list[tuple[str, str, str, str]]  # wrong, right, base_wrong, base_right
    manual: list[Pair]
    forms: dict[Pair, list[Pair]]


def lessons(pairs: DataFrame, manual: DataFrame) -> Lessons:
    """Of a dictionary (seq, wrong, right) and manual pairs (seq, wrong, right)."""
    known = [tuple(r) for r in expand_pairs(pairs).orderBy("ord").select("wrong", "right", "base_wrong", "base_right").collect()]
    extra = [tuple(r) for r in manual.orderBy("seq").select("wrong", "right").collect()]
    fresh = first_by(manual.where(is_auto_pair(F.col("wrong"), F.col("right"))), ["wrong", "right"]).join(pairs.select("wrong", "right").distinct(), ["wrong", "right"], "left_anti")
    forms: dict[Pair, list[Pair]] = {}
    for r in forms_of(fresh.select("seq", "wrong", "right")).orderBy("seq", "k").collect():
        forms.setdefault((r["base_wrong"], r["base_right"]), []).append((r["wrong"], r["right"]))
    return Lessons(known, extra, forms)


Lesson = tuple[int, int, Pair]  # the place of the file, the place in its statistics, the pair


class _InTime:
    """All rules that there may ever be, of which those hold that the lessons up to a place leave.

    A taught pair's forms hold after the file that taught it.  A manual rule that is also such a form holds
    at its own place in the order up to then, and at that of the form afterwards.  Longer rules come first;
    of one length those of the dictionary, then taught ones as they were taught, then manual ones.
    """

    def __init__(self, table: Lessons, given: Rules):
        self.table = table
        rules: dict[Pair, Pair] = {(w, r): (bw, br) for w, r, bw, br in table.known}
        self.fixed = set(rules)
        self.order = {i: (-len(x[0]), 0, i, 0) for i, x in enumerate(rules)}
        self.literals = list(rules)
        self.forms: dict[Pair, int] = {}
        # A pair is taught by a rule of its own that is applied, so one that its gates always hold back never is, nor do its forms hold.
        for form in dict.fromkeys(f for base, forms in table.forms.items() if verdict(given, base) is not False for f in forms):
            if form not in self.fixed:
                self.forms[form] = len(self.literals)
                self.literals.append(form)
        self.by_hand: dict[Pair, int] = {}
        for k, pair in enumerate(dict.fromkeys(table.manual)):
            if pair not in self.fixed:
                i = self.by_hand[pair] = len(self.literals)
                self.literals.append(pair)
                self.order[i] = (-len(pair[0]), 2, k, 0)
                rules[pair] = pair
        self.bases = rules
        self.ordered = Ordered(self.literals)
        self.taught: dict[Pair, Pair] = {}
        self.count = 0
        self.aside: list[tuple[Pair, tuple]] = []
        changing = {*self.forms.values(), *(i for pair, i in self.by_hand.items() if pair in self.forms)}
        self.pieces = Pieces(self.ordered, self.order, [verdict(given, pair) for pair in self.literals], changing)
        self.own = replace(given, literals=tuple(self.literals), bases=self)
        self.ready = self, Ordered(given.stable)
        self.plain = not (given.topic_rules and (given.contextual or given.families or given.compounds or given.regexes))

    def forget(self) -> None:
        for form in self.taught:
            self.order.pop(self.forms[form])
            self.pieces.changed(self.forms[form])
            self.bases.pop(form, None)
        for pair, place in self.aside:
            self.order[self.by_hand[pair]] = place
            self.pieces.changed(self.by_hand[pair])
            self.bases[pair] = pair
        self.taught, self.count, self.aside = {}, 0, []

    def teach(self, pair: Pair) -> None:
        for k, form in enumerate(self.table.forms[pair]):
            if form in self.fixed or form in self.taught:
                continue
            self.taught[form] = self.bases[form] = pair
            self.order[self.forms[form]] = (-len(form[0]), 1, self.count, k)
            self.pieces.changed(self.forms[form])
            if form in self.by_hand:
                self.aside.append((form, self.order.pop(self.by_hand[form])))
                self.pieces.changed(self.by_hand[form])
        self.count += 1

    def fold(self, text: str, gate=None):
        return self.pieces.fold(text) or self.ordered.fold(text, gate, self.order)

    def rewritten(self, text: str):
        return rewrite_text(text, self.own, ready=self.ready)

    def shows_nothing(self, text: str, shown) -> bool:
        """Whether it is plain that no pair is applied that may be taught and is not among those shown."""

        def loud(i: int) -> bool:
            base = self.bases.get(self.literals[i])
            return base in self.table.forms and base not in shown

        return self.plain and self.pieces.quiet(text, loud)

    def get(self, pair: Pair, default=None):
        """The base of a rule that holds now."""
        return self.bases.get(pair, default)


#: The rules that this Python worker made ready last, under the name of their run: its next tasks and walks use them, and the pieces they know, again.
_READY: dict[str, _InTime] = {}


def _ready(name: str, table: Lessons, given: Rules) -> _InTime:
    if name not in _READY:
        _READY.clear()
        _READY[name] = _InTime(table, given)
    return _READY[name]


def _stat_rows(counted: list[list[tuple]]) -> pa.Array:
    """Statistics of texts as lists of structs, made of flat columns."""
    kind = pa.list_(pa.struct([("stage", pa.string()), ("ord", pa.int64()), ("wrong", pa.string()), ("right", pa.string()), ("applied", pa.int64()), ("skipped", pa.int64())]))
    ends, columns = [0], [[] for _ in kind.value_type]
    for own in counted:
        for column, values in zip(columns, zip(*own, strict=True)):  # none if there are no statistics
            column.extend(values)
        ends.append(len(columns[0]))
    flat = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind.value_type, strict=True)], fields=list(kind.value_type))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat).cast(kind)


def _walk(told, given, keep: bool, name: str):
    """Rewritten texts (keep), or the first place in each range of each pair that was applied, and where ranges begin."""

    def rows(batches):
        table, guess = told.value
        now = _ready(name, table, given)
        best: dict[Pair, tuple[int, int]] = {}
        starts: list[int] = []
        last, at, learnt, shown = None, 0, set(), set()
        for batch in batches:
            texts, stats = [], []
            for number, place, text in zip(*(batch.column(c).to_pylist() for c in ("number", "place", "text")), strict=True):
                if last is None or number != last + 1:
                    starts.append(place)
                    now.forget()
                    now.pieces.settled.clear()
                    at, learnt, shown = 0, set(), set()
                    if not keep:
                        for lesson in guess:
                            if lesson[0] < place:
                                now.teach(lesson[2])
                                learnt.add(lesson[2])
                if keep:
                    while at < len(guess) and guess[at][0] < place:
                        now.teach(guess[at][2])
                        at += 1
                last = number
                if not keep and now.shows_nothing(text or "", shown):
                    continue
                new, counted = now.rewritten(text or "")
                if keep:
                    texts.append(new)
                    stats.append(counted)
                    continue
                fresh = []
                for stage, k, wrong, right, applied, _ in counted:
                    base = now.get((wrong, right)) if stage == "pair" and applied else None
                    if base not in table.forms:
                        continue
                    shown.add(base)
                    if (place, k) < best.get(base, (place + 1, 0)):
                        best[base] = place, k
                    if base not in learnt:
                        learnt.add(base)
                        fresh.append(base)
                for base in fresh:
                    now.teach(base)
            if keep:
                yield pa.RecordBatch.from_arrays([batch.column("place"), batch.column("path"), batch.column("text"), pa.array(texts, pa.string()), _stat_rows(stats)], ["place", "path", "text", "corrected", "stats"])
        if not keep:
            out = [*((*p, *x) for p, x in best.items()), *((None, None, place, 0) for place in starts)]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64(), pa.int64()))], ["wrong", "right", "place", "k"])

    return rows


def sequential(docs: DataFrame, rules: Rules, pairs: DataFrame, manual: DataFrame, order_col: str = "doc_id", path_col: str = "path", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Documents rewritten in the order of order_col, whole numbers that differ, and the pairs that they taught.

    First (place, path, text, corrected, stats), then (seq, wrong, right, place): the pairs in the order in
    which the dictionary gets them, each with the place of the file that taught it.  The gates of `rules`
    hold for all files; its literals and bases come from the dictionary.
    """
    spark = docs.sparkSession
    table = lessons(pairs, manual)
    # numbers of files that follow each other, by which a task sees where a range of its own begins
    folder = f"{work_folder(spark, 'feedback')}/ranges"
    own = docs.select(F.col(order_col).cast("long").alias("place"), F.col(path_col).cast("string").alias("path"), F.col(text_col).alias("text"))
    own.repartitionByRange("place").sortWithinPartitions("place").withColumn("number", F.monotonically_increasing_id()).write.parquet(folder)
    rows = spark.read.parquet(folder)
    first: dict[Pair, tuple[int, int]] = {}
    since, name = None, uuid.uuid4().hex
    in_order = lambda found: sorted((*at, p) for p, at in found.items())
    while True:
        told = spark.sparkContext.broadcast((table, in_order(first)))
        some = rows if since is None else rows.where(F.col("place") >= since)
        found = some.mapInArrow(_walk(told, rules, False, name), "wrong string, right string, place long, k long").groupBy("wrong", "right", F.when(F.col("wrong").isNull(), F.col("place")).alias("start")).agg(F.min(F.struct("place", "k")).alias("at"))
        now = {p: at for p, at in first.items() if since is not None and at[0] < since}
        starts = []
        for r in found.collect():  # as many as manual pairs and ranges
            if r["wrong"] is None:
                starts.append(r["start"])
            else:
                now.setdefault((r["wrong"], r["right"]), (r["at"]["place"], r["at"]["k"]))
        changed = [at[0] for p in first.keys() | now.keys() if first.get(p) != now.get(p) for at in (first.get(p), now.get(p)) if at]
        told.unpersist()
        first = now
        since = min((s for s in starts if changed and s > min(changed)), default=None)  # the range of the first change is right, as are those before
        if since is None:
            break
    told = spark.sparkContext.broadcast((table, in_order(first)))
    done = rows.mapInArrow(_walk(told, rules, True, name), f"place long, path string, text string, corrected string, stats {STATS}")
    return done, spark.createDataFrame([(i, *p, place) for i, (place, _, p) in enumerate(in_order(first))], "seq long, wrong string, right string, place long")
