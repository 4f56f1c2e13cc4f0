"""Problem 2: free-entered values mapped to the entries of a list.

A multi-pattern automaton over the canonical names and their aliases finds mentions embedded in a value; the
longest mentions that do not overlap win. Values without one go to token-set similarity
(functions/tokensets.py). What neither finds is reported as `none`.

A value is judged by itself, so rows are mapped where they lie: values equal to an entry leave on the JVM
side, the rest pass a Python worker in Arrow batches with a memory of values already judged. Nothing is
shuffled, and a value that fills a third of the rows costs one look-up in each worker.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.tokensets import TokenSets, meant, words

#: Lists above this many entries are not sent to the workers whole, but in slices (see mapped()).
LARGEST_LIST = 200_000
#: Usual short forms of words in names of places.
SHORT_FORMS = {
    "junction": ("jct", "junc", "jn"), "crossing": ("xing", "crossg"), "landing": ("ldg", "landg"), "heights": ("hts", "hgts"),
    "springs": ("spgs", "sprgs", "spr"), "mills": ("mls", "ml"), "falls": ("fls",), "ferry": ("fy", "fry"), "mount": ("mt",), "saint": ("st",), "fort": ("ft",),
}
#: Usual short forms of the names of American states, by postal code.
STATE_FORMS = {
    "AL": "ala", "AK": "alaska", "AZ": "ariz", "AR": "ark", "CA": "cal calif", "CO": "colo", "CT": "conn", "DE": "del", "FL": "fla", "GA": "ga", "ID": "ida",
    "IL": "ill ills", "IN": "ind", "IA": "ia", "KS": "kan kans kas", "KY": "ky", "LA": "la", "ME": "me", "MD": "md", "MA": "mass", "MI": "mich", "MN": "minn",
    "MS": "miss", "MO": "mo", "MT": "mont", "NE": "neb nebr", "NV": "nev", "NH": "n_h", "NJ": "n_j", "NM": "n_m", "NY": "n_y", "NC": "n_c", "ND": "n_d n_dak",
    "OH": "o", "OK": "okla", "OR": "ore oreg", "PA": "penn penna", "RI": "r_i", "SC": "s_c", "SD": "s_d s_dak", "TN": "tenn", "TX": "tex", "UT": "utah",
    "VT": "vt", "VA": "va", "WA": "wash", "WV": "w_va", "WI": "wis wisc", "WY": "wyo",
}

FILLERS = frozenset("near at city of town vicinity the in".split())

Judge = Callable[[str], tuple[str, int]]


class Mentions:
    """An automaton over word sequences: pattern text -> whatever it stands for."""

    def __init__(self, patterns: Iterable[tuple[str, object]]):
        self.automaton, together = ahocorasick.Automaton(), {}
        for text, meaning in patterns:
            together.setdefault(text, set()).add(meaning)
        for text, meanings in together.items():
            self.automaton.add_word(text, (len(text), frozenset(meanings)))
        self.any = bool(together)
        if self.any:
            self.automaton.make_automaton()

    def find(self, tokens: list[str]) -> list[tuple[int, int, frozenset]]:
        """(first letter, letter after, meanings) in the blank-joined tokens; whole words, longest first, none overlapping."""
        text = " ".join(tokens)
        if not self.any or not text:
            return []
        found = []
        for last, (n, meanings) in self.automaton.iter(text):
            start, end = last + 1 - n, last + 1
            if (start == 0 or text[start - 1] == " ") and (end == len(text) or text[end] == " "):
                found.append((start, end, meanings))
        taken: list[tuple[int, int, frozenset]] = []
        for m in sorted(found, key=lambda m: (m[0] - m[1], m[0])):
            if all(m[1] <= t[0] or m[0] >= t[1] for t in taken):
                taken.append(m)
        return taken


def _aliases(town: list[str]) -> Iterator[str]:
    """The name itself and with any one of its words in a short form."""
    yield " ".join(town)
    for i, w in enumerate(town):
        for short in SHORT_FORMS.get(w, ()):
            yield " ".join([*town[:i], short, *town[i + 1 :]])


class Places:
    """entries: (place_id, town, state_code, state_name)."""

    def __init__(self, entries: list[tuple[str, str, str, str]]):
        self.state_of = {e: code for e, _, code, _ in entries}
        by_town: dict[str, set[str]] = {}
        for e, town, _, _ in entries:
            by_town.setdefault(" ".join(words(town)), set()).add(e)
        self.by_town = by_town
        self.towns_of: dict[str, set[str]] = {}
        for e, town, code, _ in entries:
            self.towns_of.setdefault(code, set()).add(" ".join(words(town)))
        self.towns = Mentions((a, t) for t in by_town for a in _aliases(t.split()))
        forms = {(" ".join(words(n)), c) for _, _, c, n in entries} | {(c.lower(), c) for _, _, c, _ in entries}
        forms |= {(f.replace("_", " "), c) for _, _, c, _ in entries for f in STATE_FORMS.get(c, "").split()}
        self.states = Mentions(forms)
        self.similar = TokenSets({t: t for t in by_town})
        self.expand = {short: w for w, shorts in SHORT_FORMS.items() for short in shorts}

    def _state(self, tokens: list[str]) -> tuple[str | None, list[str]]:
        """The state that the value begins or ends with, and the other words."""
        text = " ".join(tokens)
        ends = [m for m in self.states.find(tokens) if m[0] == 0 or m[1] == len(text)]
        for start, end, codes in sorted(ends, key=lambda m: -m[1]):
            rest = (text[:start] + text[end:]).split()
            if rest and len(codes) == 1:
                return next(iter(codes)), rest
        return None, tokens

    def judge(self, value: str) -> str:
        """The place_id meant, or none: also where a town of several states is named without its state."""
        return self.scored(value)[0]

    def scored(self, value: str) -> tuple[str, int]:
        """The place_id or none, and the letters of the name that was found less twice the edits; nought if none was."""
        tokens = words(value)
        state, rest = self._state(tokens)
        inside = self.towns_of.get(state, set()) if state else None
        plain = [self.expand.get(w, w) for w in rest if w not in FILLERS]
        mentions = self.towns.find(rest) or self.towns.find(tokens)
        towns = mentions[0][2] if mentions else frozenset()
        # letters beside the mention may belong to a longer name that is misspelt
        named = max((len(t.replace(" ", "")) for t in towns), default=0)
        left, score = sum(map(len, plain)) - named, named
        if left > 0:
            town, cost = self.similar.best(plain, inside)
            if town and (not towns or (len(town.replace(" ", "")) > named and cost < left)):
                towns, score = {town}, len(town.replace(" ", "")) - 2 * cost
        entries = {e for t in towns for e in self.by_town[t] if state in (None, self.state_of[e])}
        return (next(iter(entries)) if len(entries) == 1 else "none"), score if entries else 0


class Names:
    """entries: (entry id, name). Ids and names are matched by their words, ids also without their first word."""

    def __init__(self, entries: list[tuple[str, str]]):
        forms: dict[str, set[str]] = {}
        for e, name in entries:
            own = words(e)
            for form in {" ".join(own), " ".join(words(name)), " ".join(own[1:])} - {""}:
                forms.setdefault(form, set()).add(e)
        self.mentions = Mentions((f, e) for f, es in forms.items() if len(es) == 1 for e in es)
        self.similar = TokenSets({f: next(iter(es)) for f, es in forms.items() if len(es) == 1 and len(f) > 3})
        self.exact = {f: next(iter(es)) for f, es in forms.items() if len(es) == 1}

    def judge(self, value: str) -> str:
        return self.scored(value)[0]

    def scored(self, value: str) -> tuple[str, int]:
        """The entry or none, and the letters found less twice the edits."""
        tokens = words(value)
        letters = sum(map(len, tokens))
        whole = self.exact.get(" ".join(tokens))
        if whole:
            return whole, letters
        near, cost = self.similar.best(tokens)
        found = self.mentions.find(tokens)
        if found and not (near and cost <= 1):
            longest = {e for s, t, es in found for e in es if t - s == found[0][1] - found[0][0]}
            mention = " ".join(tokens)[found[0][0] : found[0][1]].split()
            if len(longest) == 1 and (near is None or near in longest) and meant(value, mention):
                return next(iter(longest)), sum(map(len, mention))
        return (near, max(1, letters - 2 * cost)) if near else ("none", 0)


def mapped(rows: DataFrame, id_col: str, value_col: str, field: str, makers: list[Callable[[], Judge]], blanks: bool = False) -> DataFrame:
    """(record_id, field_name, entry_id) of rows whose value is not null nor, unless blanks, blank; entry_id is `none` where no entry is meant.

    Each maker builds the judge of one slice of the list, once in each worker. Usually there is one, and rows stay where they lie.
    Of several slices the best score wins, and equal scores of different entries mean none. Other columns are not read.
    """
    kept = rows.select(F.col(id_col).alias("id"), F.col(value_col).alias("value")).where(F.col("value").isNotNull() if blanks else F.col("value").rlike(r"\S"))
    kind = rows.schema[id_col].dataType.simpleString()

    def judged(source: DataFrame, keys: list[str], make: Callable[[], Judge]) -> DataFrame:
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            judge = functools.lru_cache(maxsize=1 << 17)(make())
            for pdf in batches:
                got = pdf["value"].map(judge)
                yield pd.DataFrame({k: pdf[k] for k in keys} | {"entry_id": got.str[0].astype(object), "score": got.str[1].astype("int64")})

        types = {"id": kind, "value": "string"}
        return source.mapInPandas(run, ", ".join(f"{k} {types[k]}" for k in keys) + ", entry_id string, score bigint")

    if len(makers) == 1:
        done = judged(kept, ["id"], makers[0])
    else:
        distinct, parts = kept.select("value").distinct(), None
        for make in makers:
            part = judged(distinct, ["value"], make)
            parts = part if parts is None else parts.unionByName(part)
        best = parts.groupBy("value").agg(F.max("score").alias("top"), F.collect_list(F.struct("score", "entry_id")).alias("all"))  # one for each slice
        first = F.array_distinct(F.transform(F.filter("all", lambda x: x["score"] == F.col("top")), lambda x: x["entry_id"]))
        best = best.select("value", F.when((F.size(first) == 1) & (F.col("top") > 0), first[0]).otherwise("none").alias("entry_id"))
        done = kept.join(best, "value")
    return done.select(F.col("id").alias("record_id"), F.lit(field).alias("field_name"), "entry_id")


def _slices(ref: DataFrame, columns: list[str], by: str) -> list[list[tuple]]:
    """The list's entries in slices of about LARGEST_LIST, entries of one name together; one slice unless the list is larger."""
    entries = ref.select(*columns).dropna().dropDuplicates()
    n = max(1, math.ceil(entries.count() / LARGEST_LIST))
    part = F.pmod(F.xxhash64(F.lower(F.trim(by))), F.lit(n))
    return [[tuple(r) for r in entries.where(part == i).collect()] for i in range(n)]


def _without_exact(rows: DataFrame, exact: DataFrame, value_col: str, slices: int) -> DataFrame:
    """Rows whose value is no entry letter for letter; the list is broadcast only if one slice holds it."""
    names = exact.dropna().distinct()
    return rows.join(F.broadcast(names) if slices == 1 else names, value_col, "left_anti")


def resolve_places(rows: DataFrame, ref: DataFrame, id_col: str = "record_id", value_col: str = "location") -> DataFrame:
    """Every non-blank value that is not letter for letter a place_name. An empty list gives `none` throughout."""
    slices = _slices(ref, ["place_id", "town", "state_code", "state_name"], "town")
    kept = _without_exact(rows.select(id_col, value_col), ref.select(F.col("place_name").alias(value_col)), value_col, len(slices))
    return mapped(kept, id_col, value_col, value_col, [lambda s=s: Places(s).scored for s in slices])


def resolve_names(rows: DataFrame, ref: DataFrame, id_col: str = "record_id", value_col: str = "commodity_id", name_col: str = "commodity_name") -> DataFrame:
    """Every value that is not one of the list's ids, blank ones included; null is no value."""
    slices = _slices(ref, [value_col, name_col], value_col)
    kept = _without_exact(rows.select(id_col, value_col), ref.select(value_col), value_col, len(slices))
    return mapped(kept, id_col, value_col, value_col, [lambda s=s: Names(s).scored for s in slices], blanks=True)
