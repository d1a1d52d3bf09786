"""Ordered literal rules by the thousand: an automaton tells which can fire, a graph which can cause others.

A fold applies rules one after the other, each to what the rules before it left, so a rule may
make the input of a later one and none can be skipped for the text as it was at first.  Here a
text is scanned once for the inputs of all rules.  Those found wait in the order of the rules.
A rule that fires is followed, in a graph made beforehand, to the later rules whose input its output can
be part of: an input that holds the output or lies in it, or that shares an end with it.  Only where
there are some, the places that it changed are scanned again, and what is new there joins those that
wait.  Every input that comes up overlaps a changed place, so the result and its counts are those of
the plain fold, while the time goes with the rules that fire, not with the rules there are.
"""

from __future__ import annotations

import heapq
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rules of one automaton, which takes about 300 bytes for each in every Python worker; a longer table is applied in runs of so many, one after the other.
RULES_A_PASS = 2_000_000

#: Characters of a part of a text whose result is kept, and results that one worker keeps (twice as many while older ones are still used).
KNOWN_CHARS, MOST_KNOWN = 32, 60_000

Gate = Callable[[int, str, int, int], bool]


def _automaton(words: Iterable[tuple[str, list[int]]]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for word, value in words:
        found.add_word(word, value)
    if len(found):
        found.make_automaton()
    return found


def reach(rules: list[tuple[str, str]]) -> list[int]:
    """For each rule, the last later rule whose input its output can be part of, or -1.

    An output of no characters joins what stands on either side, so it can be part of any input
    of two characters or more.
    """
    at: dict[str, int] = {}  # the last rule with this input, with this beginning, with this end
    heads: dict[str, int] = {}
    tails: dict[str, int] = {}
    longest = max((len(r) for _, r in rules), default=0)
    for j, (wrong, _) in enumerate(rules):
        at[wrong] = j
        for n in range(1, min(len(wrong) - 1, longest) + 1):
            heads[wrong[:n]] = tails[wrong[len(wrong) - n :]] = j
    inputs = _automaton((w, [j]) for w, j in at.items())
    outputs = _automaton((r, [k]) for k, r in enumerate(dict.fromkeys(r for _, r in rules if r)))
    inside: dict[str, int] = {}  # outputs that lie in an input
    names = list(dict.fromkeys(r for _, r in rules if r))
    if names:
        for wrong, j in at.items():
            for _, (k,) in outputs.iter(wrong):
                inside[names[k]] = max(j, inside.get(names[k], -1))
    any_long = max((j for w, j in at.items() if len(w) > 1), default=-1)
    known: dict[str, int] = {"": any_long}
    out = []
    for i, (_, right) in enumerate(rules):
        if right not in known:
            found = [inside.get(right, -1), *(j for _, (j,) in inputs.iter(right))]
            for n in range(1, len(right) + 1):
                found += [heads.get(right[len(right) - n :], -1), tails.get(right[:n], -1)]
            known[right] = max(found)
        out.append(known[right] if known[right] > i else -1)
    return out


def last_with(rules: Iterable[tuple[str, str]]) -> dict[str, int]:
    """For each character, the last rule whose input has it; for '' the last whose input has two or more."""
    last: dict[str, int] = {"": -1}
    for i, (wrong, _) in enumerate(rules):
        for c in wrong:
            last[c] = i
        if len(wrong) > 1:
            last[""] = i
    return last


class Packed:
    """Many short strings as one, with the places where they end: a few bytes for each, in place of an object."""

    def __init__(self, texts: Iterable[str]):
        parts, self.ends = [], array("Q", [0])
        for t in texts:
            parts.append(t)
            self.ends.append(self.ends[-1] + len(t))
        self.all = "".join(parts)

    def __len__(self) -> int:
        return len(self.ends) - 1

    def __getitem__(self, i: int) -> str:
        return self.all[self.ends[i] : self.ends[i + 1]]

    def __iter__(self) -> Iterator[str]:
        return (self[i] for i in range(len(self)))


class Ordered:
    """A list of rules (wrong, right) in the order of application.

    An input that comes up shares a character with the output that made it, and is no longer than the longest
    input of the later rules, so only where a later rule has one is the text scanned again, and only that far.
    Characters that no input has stay where they are and no match spans them, so what stands between them
    is folded on its own, and what comes again is looked up.
    """

    def __init__(self, rules: Iterable[tuple[str, str]] = (), packed: tuple[Packed, Packed] | None = None):
        import ahocorasick

        if packed is None:
            given = list(rules)
            packed = Packed(w for w, _ in given), Packed(r for _, r in given)
        self.wrong, self.right = packed
        n = len(self.wrong)
        self.more: dict[int, list[int]] = {}  # rules with the input of an earlier one
        self.found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, wrong in enumerate(self.wrong):
            if wrong:
                if (first := self.found.get(wrong, -1)) < 0:
                    self.found.add_word(wrong, i)
                else:
                    self.more.setdefault(first, []).append(i)
        if len(self.found):
            self.found.make_automaton()
        self.last = last_with(zip(self.wrong, self.wrong, strict=True))
        self.apart = re.compile(f"([{''.join(map(re.escape, sorted(c for c in self.last if c)))}]+)") if len(self.found) else None
        self.known: dict[str, tuple[str, list[tuple[int, int, int]]]] = {}
        self.older: dict[str, tuple[str, list[tuple[int, int, int]]]] = {}  # the ones kept before, until as many are new
        self.longest_from = array("I", bytes(4 * (n + 1)))
        for i in range(n - 1, -1, -1):
            self.longest_from[i] = max(self.longest_from[i + 1], self.wrong.ends[i + 1] - self.wrong.ends[i])
        self.longest = self.longest_from[0]

    def _due(self, text: str, start: int = 0, end: int | None = None) -> set[int]:
        some = {i for _, i in self.found.iter(text[start:end])}  # the automaton copies all that it is given
        if self.more:
            for i in [i for i in some if i in self.more]:
                some.update(self.more[i])
        return some

    def _leads(self, i: int, right: str) -> bool:
        """Whether a later rule's input may hold characters of an output; one of no characters joins what stands on either side."""
        return any(self.last.get(c, -1) > i for c in right or ("",))

    def fold(self, text: str, gate: Gate | None = None, places_of=None) -> tuple[str, list[tuple[int, int, int]]]:
        """The text after all rules, and (rule, applied, skipped) of those that met it, in order.

        gate(rule, text, start, end) may hold a match back; every match of a rule sees the text as it was
        before the rule.  places_of has a place in the order for each rule that holds, in place of its number.
        """
        if not text or not self.longest:
            return text, []
        return self._between(text) if gate is None and places_of is None else self._whole(text, gate, places_of)

    def _between(self, text: str) -> tuple[str, list[tuple[int, int, int]]]:
        parts = self.apart.split(text)
        total: dict[int, int] = {}
        for k in range(1, len(parts), 2):
            part = parts[k]
            found = self.known.get(part)
            if found is None:
                found = self.older.get(part) or self._whole(part, None, None)
                if len(part) <= KNOWN_CHARS:
                    if len(self.known) >= MOST_KNOWN:
                        self.known, self.older = {}, self.known
                    self.known[part] = found
            parts[k] = found[0]
            for i, n, _ in found[1]:
                total[i] = total.get(i, 0) + n
        return "".join(parts), [(i, total[i], 0) for i in sorted(total)]

    def _whole(self, text: str, gate: Gate | None, places_of) -> tuple[str, list[tuple[int, int, int]]]:
        seen = self._due(text)
        waiting = sorted(seen if places_of is None else ((places_of[i], i) for i in seen if i in places_of))
        stats = []
        while waiting:
            now = heapq.heappop(waiting)
            i = now if places_of is None else now[1]
            wrong = self.wrong[i]
            at = text.find(wrong)
            if at < 0:
                continue
            right = self.right[i]
            size, skipped, grown, places = len(wrong), 0, len(right) - len(wrong), []
            if gate is None:
                while at >= 0:
                    places.append(at + grown * len(places))
                    at = text.find(wrong, at + size)
                text = text.replace(wrong, right)
                stats.append((i, len(places), 0))
            else:
                out, last = [], 0
                while at >= 0:
                    end = at + size
                    if gate(i, text, at, end):
                        out += (text[last:at], right)
                        places.append(at + grown * len(places))
                        last = end
                    else:
                        skipped += 1
                    at = text.find(wrong, end)
                stats.append((i, len(places), skipped))
                if not places:
                    continue
                text = "".join([*out, text[last:]])
            if places_of is not None:
                for new in self._around(text, places, len(right), self.longest - 1):
                    if new not in seen and new in places_of and (places_of[new], new) > now:
                        seen.add(new)
                        heapq.heappush(waiting, (places_of[new], new))
            elif self._leads(i, right):
                for new in self._around(text, places, len(right), self.longest_from[i + 1] - 1):
                    if new > i and new not in seen:
                        seen.add(new)
                        heapq.heappush(waiting, new)
        return text, stats

    def _around(self, text: str, places: list[int], size: int, margin: int) -> set[int]:
        """Rules whose input of margin + 1 characters at most touches one of the places, each of a size, or spans it."""
        if len(text) <= KNOWN_CHARS:
            return self._due(text)
        some: set[int] = set()
        start, end = max(0, places[0] - margin), places[0] + size + margin
        for p in places:
            if p - margin > end:
                some |= self._due(text, start, min(end, len(text)))
                start = p - margin
            end = p + size + margin
        return some | self._due(text, start, min(end, len(text)))


class _Known(dict):
    """Values made when first asked for."""

    def __init__(self, make: Callable):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        return self.make(key)


class Pieces:
    """Folds of texts by their pieces, runs of letters and digits that inputs have, for rules that come, go and change their place.

    A rule whose verdict is true or false has it for every match; only one without verdict (None) looks at the text around.
    While no match spans two pieces, each is folded on its own, and what comes again is looked up, until a rule that
    it met changes.  A first match over a gap needs a piece that ends, in one of its versions, as the input does before the gap,
    and a next one that begins as the input goes on.  Texts that may have one, or that meet a rule without verdict, are left to the fold of the whole text.
    """

    def __init__(self, own: Ordered, places_of: dict, verdicts: list[bool | None], changing: set[int]):
        self.own, self.places_of, self.verdicts, self.changing = own, places_of, verdicts, changing
        self.wrong, self.right = list(own.wrong), list(own.right)
        self.held = {i for i, yes in enumerate(verdicts) if yes is False}  # rules that are only counted
        letters = sorted(c for c in own.last if c.isalnum())
        self.cut = re.compile(f"([{''.join(map(re.escape, letters))}]+)" if letters else "((?!))")
        inside = set(letters)
        self.apart = lambda c: c not in inside
        wide = {w for w in self.wrong if not inside.issuperset(w)}
        self.leading = tuple(sorted({w[0] for w in wide if w[0] not in inside}))
        self.ends: dict[str, list[str]] = {}  # what an input has before a sign that parts pieces, and how it goes on
        for w in wide:
            for k, c in enumerate(w):
                if k and c not in inside:
                    self.ends.setdefault(w[:k], []).append(w[k:])
        self.tails = tuple(self.ends)
        self.inert: set[str] = set()  # pieces that no rule can change, whichever hold
        self.settled: set[str] = set()
        self.users: dict[int, list[str]] = {}
        self.long: list[str] = []  # pieces that are known for one text only
        self._clear()

    def _clear(self) -> None:
        self.known = _Known(self._entry)  # the text of each piece after its fold, or None if a context must be seen
        self.codes: dict[str, tuple[int, ...]] = {}  # twice a rule for each match applied, and one more for each skipped
        self.after: dict[str, list[str]] = {}  # how inputs go on that may begin at the end of a piece, where there are some
        self.users.clear()  # pieces that met a changing rule
        self.settled.clear()

    def changed(self, rule: int) -> None:
        """Forgets the pieces that met a rule which comes, goes or changes its place."""
        for piece in self.users.pop(rule, ()):
            self.known.pop(piece, None)
            self.settled.discard(piece)

    def _entry(self, piece: str) -> str | None:
        new, codes, met, versions = self._versions(piece)
        self.known[piece], self.codes[piece] = new, codes
        if len(piece) > KNOWN_CHARS:
            self.long.append(piece)
        for i in met & self.changing:
            self.users.setdefault(i, []).append(piece)
        if any(v.endswith(self.tails) for v in versions):
            self.after[piece] = [rest for end, rests in self.ends.items() if any(v.endswith(end) for v in versions) for rest in rests]
        else:
            self.after.pop(piece, None)
        return new

    def _versions(self, piece: str) -> tuple[str | None, tuple[int, ...], set[int], list[str]]:
        """The text of a piece after its fold, codes, all rules whose input came up, and the text after each rule."""
        order, verdicts, wrong = self.places_of, self.verdicts, self.wrong
        met = self.own._due(piece)
        versions, text, codes, k = [piece], piece, [], 0
        waiting = sorted([(order[i], i) for i in met if i in order])
        long, most = len(piece) > 4 * KNOWN_CHARS, self.own.longest  # of a long piece the ends are enough
        while k < len(waiting):
            now = waiting[k]
            i, k = now[1], k + 1
            n = text.count(wrong[i])
            if not n:
                continue
            yes = verdicts[i]
            if not yes:
                if yes is None:
                    return None, (), met, versions
                codes += [2 * i + 1] * n
                continue
            codes += [2 * i] * n
            right, size, at, places = self.right[i], len(wrong[i]), text.find(wrong[i]), []
            while long and at >= 0:
                places.append(at + (len(right) - size) * len(places))
                at = text.find(wrong[i], at + size)
            text = text.replace(wrong[i], right)
            versions.append(text[:most] + text[-most:] if long else text)
            new = (self.own._around(text, places, len(right), self.own.longest - 1) if long else self.own._due(text)) - met
            if new:
                met |= new
                more = [(order[j], j) for j in new if j in order and (order[j], j) > now]
                if more:
                    waiting, k = sorted(waiting[k:] + more), 0
        return text, tuple(codes), met, versions

    def _spans(self, parts: list[str]) -> bool:
        """Whether an input may begin in one piece and go on over the gap after it."""
        for k in range(1, len(parts), 2):
            gap = parts[k + 1]
            for rest in self.after.get(parts[k], ()):
                if gap.startswith(rest):
                    return True
                if gap and rest.startswith(gap) and k + 2 < len(parts):
                    head = rest[len(gap) :]
                    size = next((n for n, c in enumerate(head) if self.apart(c)), len(head))
                    new, _, _, versions = self._versions(parts[k + 2])
                    if new is None or any(v.startswith(head[:size]) for v in versions):
                        return True
        return False

    def _room(self) -> None:
        for piece in self.long:
            for own in (self.known, self.codes, self.after):
                own.pop(piece, None)
        self.long.clear()
        if len(self.known) >= 2 * MOST_KNOWN:
            self._clear()

    def fold(self, text: str) -> tuple[str, list[tuple[int, int, int]]] | None:
        """The text after all rules that hold, and (rule, applied, skipped) in order; None if it must be folded whole."""
        if any(c in text for c in self.leading):
            return None
        self._room()
        parts = self.cut.split(text)
        pieces = parts[1::2]
        texts = list(map(self.known.__getitem__, pieces))
        if None in texts or not self.after.keys().isdisjoint(pieces) and self._spans(parts):
            return None
        parts[1::2] = texts
        total = Counter(chain.from_iterable(map(self.codes.__getitem__, pieces)))
        order = self.places_of
        return "".join(parts), [(i, total[2 * i], total[2 * i + 1]) for _, i in sorted((order[i], i) for i in {c >> 1 for c in total})]

    def quiet(self, text: str, loud: Callable[[int], bool]) -> bool:
        """Whether it is known, without a whole fold, that no loud rule is applied; pieces of which that is known are settled.

        Who calls clears what is settled when a rule becomes loud that was not before.
        """
        if any(c in text for c in self.leading):
            return False
        self._room()
        spans = False
        for piece in set(self.cut.findall(text)) - self.inert - self.settled:
            if piece not in self.known and self.own._due(piece) <= self.held and not piece.endswith(self.tails):
                if len(self.inert) >= 2 * MOST_KNOWN:
                    self.inert.clear()
                if len(piece) <= KNOWN_CHARS:
                    self.inert.add(piece)
                continue
            if self.known[piece] is None or any(not c & 1 and loud(c >> 1) for c in self.codes[piece]):
                return False
            if piece in self.after:
                spans = True
            elif len(piece) <= KNOWN_CHARS:
                self.settled.add(piece)
        return not (spans and self._spans(self.cut.split(text)))


def ordered_rules(rules: DataFrame) -> list[tuple[Packed, Packed, array]]:
    """(wrong, right, ord) in runs of at most RULES_A_PASS, in order; only one run is on its way at a time."""
    out: list[list] = [[[], [], array("q")]]
    for r in rules.select(F.col("ord").cast("long"), "wrong", "right").where("wrong <> ''").orderBy("ord").toLocalIterator():
        if len(out[-1][2]) == RULES_A_PASS:
            out[-1][:2] = map(Packed, out[-1][:2])
            out.append([[], [], array("q")])
        for column, x in zip(out[-1], (r["wrong"], r["right"], r["ord"]), strict=True):
            column.append(x)
    out[-1][:2] = map(Packed, out[-1][:2])
    return [tuple(run) for run in out]


#: The rules that this Python worker made ready last, under the name of their run: its next tasks use them again.
_READY: dict[str, tuple[Ordered, array]] = {}


def _ready(name: str, told) -> tuple[Ordered, array]:
    if name not in _READY:
        _READY.clear()
        wrong, right, ords = told.value
        _READY[name] = Ordered(packed=(wrong, right)), ords
    return _READY[name]


def fold_many(table: DataFrame, rules: DataFrame, text_col: str = "text", able_col: str | None = None) -> DataFrame:
    """table with the rules (ord, wrong, right) applied to a text column in the order of ord, and uses: array of (ord, n).

    Rows whose able_col is not true stay as they are, as do null texts.  Each row is rewritten whole in one
    pass; a table of more than RULES_A_PASS rules takes several, one after the other.
    """
    spark = table.sparkSession
    at = table.columns.index(text_col)
    able = table.columns.index(able_col) if able_col else None
    kind = pa.list_(pa.struct([("ord", pa.int64()), ("n", pa.int64())]))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema) + ", uses array<struct<ord:long,n:long>>"
    out = table.withColumn("uses", F.array().cast("array<struct<ord:long,n:long>>"))
    for run in ordered_rules(rules):
        told, name = spark.sparkContext.broadcast(run), uuid.uuid4().hex

        def rows(batches, told=told, name=name):
            own, names = _ready(name, told)
            for batch in batches:
                texts, had = batch.column(at).to_pylist(), batch.column(batch.num_columns - 1)
                starts, old = had.offsets.to_pylist(), [had.values.field(f).to_numpy(zero_copy_only=False) for f in ("ord", "n")]
                ords, ns, ends = array("q"), array("q"), array("i", [0])
                may = batch.column(able).to_pylist() if able is not None else [True] * len(texts)
                for k, (text, ok) in enumerate(zip(texts, may, strict=True)):
                    for column, values in zip((ords, ns), old, strict=True):
                        column.extend(values[starts[k] : starts[k + 1]].tolist())
                    if text and ok:
                        texts[k], stats = own.fold(text)
                        ords.extend(names[i] for i, _, _ in stats)
                        ns.extend(n for _, n, _ in stats)
                    ends.append(len(ords))
                columns = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(batch.columns[:-1])]
                flat = pa.StructArray.from_arrays([pa.array(np.array(ords, np.int64)), pa.array(np.array(ns, np.int64))], fields=list(kind.value_type))
                uses = pa.ListArray.from_arrays(pa.array(np.array(ends, np.int32)), flat).cast(kind)
                yield pa.RecordBatch.from_arrays([*columns, uses], batch.schema.names)

        out = out.mapInArrow(rows, fields)
    return out


def usage(folded: DataFrame, rules: DataFrame) -> DataFrame:
    """(wrong, right, uses) over all rows of fold_many(), for rules that were used; rules of one pair count together."""
    rows = folded.select(F.explode("uses").alias("u")).groupBy(F.col("u.ord").alias("ord")).agg(F.sum("u.n").alias("uses"))
    return rows.join(rules.select("ord", "wrong", "right"), "ord").groupBy("wrong", "right").agg(F.sum("uses").alias("uses"))
