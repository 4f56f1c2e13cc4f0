"""Token-set similarity between a typed value and the entries of a list.

Words are compared as a set: every word of an entry looks for the nearest unused word of the value,
by the number of letters changed, added, dropped or swapped with their neighbour. What is left over on
either side counts in full. An index of letter pairs leaves out the entries that cannot be near enough: an edit
changes three pairs at most (a swap), and a word run together with its neighbour or split three more.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Iterable, Mapping

#: Digits that stand for a letter in misread words.
LOOKALIKES = str.maketrans("015", "ols")


def words(value: str | None) -> list[str]:
    """Lower-case words without accents; apostrophes drop out, digits inside words are read as letters."""
    plain = unicodedata.normalize("NFKD", value or "").casefold().replace("’", "'")
    plain = "".join(c for c in plain if not unicodedata.combining(c)).replace("'", "")
    found = re.findall(r"[^\W_]+", plain)
    return [w.translate(LOOKALIKES) if re.search(r"\d", w) and re.search(r"[^\W\d]", w) else w for w in found]


#: Words after which a phrase says more of what stands before them.
_MORE_OF = frozenset("of from in at by per for to on with and or as see".split())


def meant(value: str, mention: list[str]) -> bool:
    """Whether the value is about what it mentions: by several words, or by one that no head noun of other goods follows in its phrase (cotton gin)."""
    if len(mention) > 1:
        return True
    for phrase in re.split(r"[^\w\s'’/&-]+|\s-+\s", value):
        tokens = words(phrase)
        if any(w == mention[0] and (i + 1 == len(tokens) or tokens[i + 1] in _MORE_OF) for i, w in enumerate(tokens)):
            return True
    return False


def edits(a: str, b: str, most: int = 99) -> int:
    """Letters changed, added, dropped or swapped between a and b; most + 1 stands for all larger counts."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return len(a) + len(b)
    before, row = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            d = min(row[j] + 1, now[-1] + 1, row[j - 1] + (x != y))
            if before and i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                d = min(d, before[j - 2] + 1)
            now.append(d)
        if min(now) > most:
            return most + 1
        before, row = row, now
    return min(row[-1], most + 1)


def pairs(tokens: Iterable[str]) -> set[str]:
    return {t[i : i + 2] for w in tokens for t in (f"^{w}$",) for i in range(len(t) - 1)}


class TokenSets:
    """forms: text of an entry -> entry id. Several forms may mean one entry."""

    def __init__(self, forms: Mapping[str, str], share: float = 0.25):
        self.forms = [(words(f), e) for f, e in forms.items()]
        self.share = share
        self.pairs = [pairs(t) for t, _ in self.forms]
        self.index: dict[str, list[int]] = defaultdict(list)
        for i, found in enumerate(self.pairs):
            for p in found:
                self.index[p].append(i)

    def cost(self, value: list[str], form: list[str], most: int) -> int:
        joined = edits("".join(value), "".join(form), most)  # words run together or split
        rest, total = list(value), 0
        for w in sorted(form, key=len, reverse=True):
            if rest:
                d, i = min((edits(w, v, len(w)), i) for i, v in enumerate(rest))
                if d < len(w):
                    rest.pop(i)
                    total += d
                    continue
            total += len(w)
            if total > most:
                return joined
        return min(total + sum(map(len, rest)), joined)

    def _bound(self, value: list[str], own: set[str], i: int, shared: int) -> int:
        """Edits between the value and form i that share so many pairs, at least."""
        more, fewer = max(len(value), len(self.forms[i][0])) - 1, min(len(value), len(self.forms[i][0])) - 1
        return max(0, math.ceil((max(len(own), len(self.pairs[i])) - shared - 2 * more - fewer) / 3))

    def best(self, value: list[str], only: set[str] | None = None) -> tuple[str | None, int]:
        """(entry, edits) of the nearest entry within the allowed share of its letters; ties give (None, edits)."""
        own = pairs(value)
        if not own:
            return None, 0
        hits = Counter(i for p in own for i in self.index.get(p, ()) if only is None or self.forms[i][1] in only)
        # (the least edits that the pairs allow, pairs not shared, form): the nearest are likely to come first
        ranked = sorted((self._bound(value, own, i, n), max(len(own), len(self.pairs[i])) - n, i) for i, n in hits.items())
        costs: dict[str, int] = {}
        least: float = math.inf
        for bound, _, i in ranked:
            if bound > least:
                break  # all that follow are dearer
            form, entry = self.forms[i]
            most = min(int(self.share * sum(map(len, form))), least)
            if bound <= most and (c := self.cost(value, form, most)) <= most:
                costs[entry], least = min(c, costs.get(entry, c)), min(c, least)
        if not costs:
            return None, 0
        nearest = [e for e, c in costs.items() if c == least]
        return (nearest[0] if len(nearest) == 1 else None), int(least)
