"""Restoring text that was decoded with the wrong character encoding (problem 8).

A best-first search over runs of non-ASCII characters and entities. Its states are texts, its operations are
encode-and-decode pairs and unescaping, and a set of hashes keeps visited states out. The cost of a text is how
implausible its characters are next to each other: minus the log of the probability of each pair, from counts over all
documents mixed with a prior by kind of character. The cheapest reachable text is taken, each operation having a cost
of its own; the search ends when no open state can be cheaper, whatever its number. A chain found for a run is then
tried on the other runs of the same document, which lifts runs too short to tell by themselves.

Between single-byte code pages, letters become letters, and a run alone says too little: there a document's words are
divided into passages, each as it is or seen as one code page and written in another, by a shortest path over all words.
"""

from __future__ import annotations

import codecs
import heapq
import html
import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import Shared, once

# The encodings UTF-8 text is commonly mistaken for, and the Cyrillic code pages.
WRONG_FOR_UTF8 = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251", "koi8_r", "cp866", "cp1250", "iso8859_2")
CYRILLIC = ("cp1251", "koi8_r", "cp866", "mac_cyrillic", "iso8859_5")
#: The pairs told by passages: a Cyrillic code page seen as another one, or as the Western one of its family.
PASSAGE_PAIRS = (
    *((a, b) for a in CYRILLIC for b in CYRILLIC if a != b), *((a, b) for a in ("latin-1", "cp1252") for b in CYRILLIC), ("cp437", "cp866"), ("mac_roman", "mac_cyrillic"),
)
#: Costs, in nats as all others: of an operation on a run, of entering a passage, of each word in it, of leaving it.
OP_COST, ENTER_COST, WORD_COST, LEAVE_COST = 5.0, 18.0, 2.0, 2.0
#: The most a character of a text costs as it is there: texts have signs and words that are new to the counts. What an
#: operation makes of it has no such excuse.
NOVEL = 9.0
#: How many observations the prior counts for.
PRIOR_WEIGHT = 50.0

_UTF8 = re.compile(rb"[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}")
_ENTITY = r"&(?:amp;)*(?:[A-Za-z]{2,8}|#\d{2,5}|#x[0-9a-fA-F]{2,4});"
_WORD = re.compile(r"[^\x00-\x7f]+")
_RUN = re.compile(rf"(?:[^\x00-\x7f]|{_ENTITY})+")
#: A token that isn't ASCII; the look behind keeps the search linear.
_TOKEN = re.compile(r"(?<![^\x00-\x20])[\x21-\x7f]*+[^\x00-\x7f][^\x00-\x20]*")
#: What every operation needs: two neighbouring non-ASCII characters, a replacement character or an entity; or a whole
#: word of another code page, which has two such characters as well.
NEEDED = r"[^\x00-\x7F]{2}|\x{FFFD}|&(?:amp;)*(?:[A-Za-z]{2,8}|#[0-9]{2,5}|#x[0-9a-fA-F]{2,4});"


@lru_cache(maxsize=None)
def _table(codec: str):
    """The map of a single-byte codec from characters to bytes; bytes it leaves undefined stand for the control characters
    of their number."""
    return codecs.charmap_build("".join(bytes([b]).decode(codec, "ignore") or chr(b) for b in range(256)))


def undo_utf8(text: str, codec: str) -> str | None:
    """``text`` with every stretch that is valid multi-byte UTF-8 in ``codec`` decoded, the rest as it is."""
    raw = codecs.charmap_encode(text, "replace", _table(codec))[0]
    out, at = [], 0
    for m in _UTF8.finditer(raw):
        out.append(text[at : m.start()])
        out.append(m.group().decode("utf-8"))
        at = m.end()
    return "".join(out) + text[at:] if out else None


def undo_double_byte(text: str, codec: str) -> str | None:
    """``text`` re-encoded whole to a double-byte encoding and decoded as UTF-8."""
    try:
        out = text.encode(codec).decode("utf-8")
    except UnicodeError:
        return None
    return out if out != text else None


def undo_single(text: str, seen_as: str, written_in: str) -> str | None:
    """``text`` re-decoded whole from one single-byte encoding to another."""
    try:
        return codecs.charmap_encode(text, "strict", _table(seen_as))[0].decode(written_in)
    except UnicodeError:
        return None


def _kind(c: str) -> str:
    """ASCII: a lower, A upper, 0 digit, blank space or control, . other. Letters: l L Latin and phonetic, c C Cyrillic,
    g G Greek, k others, w full-width forms. m mark, q quote, d dash, s space, i invisible, o symbol, f replacement
    character, x control, unassigned or private. Modifier letters count as marks."""
    o = ord(c)
    if o < 0x80:
        return "a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else " " if o <= 0x20 or o == 0x7F else "."
    if c == "�":
        return "f"
    cat = unicodedata.category(c)
    if cat in ("Cn", "Co", "Cs", "Cc"):
        return "x"
    if 0x2B0 <= o < 0x300:
        return "m"
    if 0xFF00 <= o < 0xFFF0:
        return "w"
    if cat[0] == "L" and c not in "ªº":
        kind = "c" if 0x400 <= o < 0x530 else "g" if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000 else "l" if o < 0x2B0 or 0x1E00 <= o < 0x1F00 else "k"
        return kind.upper() if kind != "k" and cat in ("Lu", "Lt") else kind
    if c in "‹›":
        return "o"
    return {"M": "m", "Z": "s"}.get(cat[0]) or {"Pi": "q", "Pf": "q", "Ps": "q", "Pd": "d", "Cf": "i"}.get(cat) or ("d" if c in "…•" else "o")


#: The prior: the cost of a kind of character, and how many characters of a kind there are to choose from.
_KIND_COST = {" ": 1.0, "a": 1.0, "A": 2.0, "0": 2.0, ".": 1.5, "l": 0.5, "L": 1.5, "c": 0.5, "C": 1.5, "g": 1.0, "G": 2.0, "k": 0.2, "w": 1.5, "m": 4.0, "q": 1.5, "d": 2.0, "s": 4.0, "i": 5.0, "o": 1.0, "f": 12.0, "x": 14.0}
_SIZE = {"l": 100, "L": 60, "c": 33, "C": 33, "g": 25, "G": 25, "k": 10_000, "w": 94, "m": 100, "q": 8, "d": 8, "s": 15, "i": 10, "o": 1000, "f": 1, "x": 10_000}
_SCRIPT = {"a": "l", "A": "l", "l": "l", "L": "l", "c": "c", "C": "c", "g": "g", "G": "g", "k": "k", "w": "w"}


def _link(x: str, y: str) -> float:
    """What the kinds of two neighbours cost beyond that of ``y`` alone."""
    a, b = KIND(x), KIND(y)
    s, t = _SCRIPT.get(a), _SCRIPT.get(b)
    if s and t:
        return 5.0 if s != t else 2.5 if a.islower() and b.isupper() else 1.5 if a in "lL" and b in "lL" else 0.0
    if b == "m":
        return 0.0 if s else 5.0
    if "o" in (a, b) and (s or t):
        return 4.0
    return 1.5 if a in "oqdsx" and b in "oqdsx" and x != y else 0.0


KIND = lru_cache(maxsize=70_000)(_kind)


POOLED = "\uf000"


@lru_cache(maxsize=70_000)
def symbol(c: str) -> str:
    """What a character is counted as: ASCII by its kind, letters and marks of Latin, phonetic, Greek and Cyrillic script
    and general punctuation as they are, all others by their kind (in the private use area). So there are fewer than
    2,500 symbols, and the counts have a bound that doesn't depend on the texts."""
    o = ord(c)
    if o < 0x80:
        return {"a": "a", "A": "A", "0": "0", " ": " "}.get(KIND(c), ".")
    if o < 0x530 or 0x1E00 <= o < 0x1F00 or 0x2000 <= o < 0x2070 or 0x20A0 <= o < 0x2150:
        return c
    return chr(ord(POOLED) + ord(KIND(c)))


@lru_cache(maxsize=100_000)
def _pairs_of(token: str) -> frozenset[str]:
    """Pairs of symbols of a token that holds nothing garbled by the prior alone, with a blank on both sides; none of others."""
    if "�" in token or any(PRIOR.search(m.group())[1] for m in _WORD.finditer(token) if len(m.group()) > 1):
        return frozenset()
    s = [" ", *map(symbol, token), " "]
    return frozenset(x + y for x, y in zip(s, s[1:], strict=False) if not (x.isascii() and y.isascii()))


def count_pairs(texts: Iterable[str | None]) -> Counter:
    """Pairs of symbols to the number of texts that hold them in tokens that aren't garbled by the prior alone."""
    n: Counter = Counter()
    for t in texts:
        if t and not t.isascii():
            n.update(set().union(*map(_pairs_of, set(_TOKEN.findall(t)))))
    return n


class Plausibility:
    """Costs of characters next to each other, from counts of pairs of symbols."""

    def __init__(self, counts: dict[str, int] | None = None):
        self.pairs = dict(counts or {})
        self.first: dict[str, int] = {}
        self.single: dict[str, int] = {}
        self.kinds: dict[str, int] = {}
        self.folded: dict[str, int] = {}
        self.folded_first: dict[str, int] = {}
        for (x, y), n in self.pairs.items():
            low = x.lower()[:1] + y.lower()[:1]
            self.folded[low] = self.folded.get(low, 0) + n
            self.folded_first[low[0]] = self.folded_first.get(low[0], 0) + n
            self.first[x] = self.first.get(x, 0) + n
            self.single[y] = self.single.get(y, 0) + n
            k = chr(ord(y) - ord(POOLED)) if y >= POOLED else KIND(y)
            self.kinds[k] = self.kinds.get(k, 0) + n
        self._pair: dict[str, float] = {}
        self.search = lru_cache(maxsize=200_000)(self._search)
        self.readings = lru_cache(maxsize=200_000)(self._readings)
        self.token = lru_cache(maxsize=200_000)(self._token)

    def alone(self, y: str) -> float:
        """The cost of a character by its kind and by how often its symbol is seen among the kind's."""
        k, b = KIND(y), symbol(y)
        if k not in _SIZE:
            return _KIND_COST[k]
        share = (self.single.get(b, 0) + PRIOR_WEIGHT * (0.5 if b >= POOLED else 1.0 / _SIZE[k])) / (self.kinds.get(k, 0) + PRIOR_WEIGHT)
        return _KIND_COST[k] - math.log(share)

    def pair(self, x: str, y: str) -> float:
        """Minus the log of the probability of ``y`` after ``x``; between two ASCII characters nothing. What pairs lack in
        counts, the pairs of any case lend them, and these the single characters. Characters counted together share the
        probability of their symbol; a symbol said again is cheap."""
        xy = x + y
        c = self._pair.get(xy)
        if c is None:
            a, b = symbol(x), symbol(y)
            if x.isascii() and y.isascii():
                c = 0.0
            elif x == y and KIND(y) in "odq":
                c = 1.0
            else:
                link = _link(x, y)
                low = a.lower()[:1] + b.lower()[:1]
                alone = math.exp(-self.alone(b.lower()[:1] if b < POOLED else y) - (link if link != 2.5 else 0.0))
                folded = (self.folded.get(low, 0) + PRIOR_WEIGHT * alone) / (self.folded_first.get(low[0], 0) + PRIOR_WEIGHT)
                folded *= math.exp(-(link if link == 2.5 else 1.0 if b != b.lower() else 0.0))
                p = (self.pairs.get(a + b, 0) + PRIOR_WEIGHT * folded) / (self.first.get(a, 0) + PRIOR_WEIGHT)
                c = -math.log(p) + (math.log(_SIZE[KIND(y)]) if b >= POOLED else 0.0)
            self._pair[xy] = c
        return c

    def cost(self, text: str, before: str = " ", after: str = " ", given: bool = False) -> float:
        """How implausible a run of characters is between its two neighbours; ``given`` if it is there as it is. An entity
        left in the text is no better than a rare symbol."""
        left = 0
        if "&" in text:
            text, left = re.subn(_ENTITY, ".", text)
        s = f"{before}{text}{after}"
        pairs = map(self.pair, s, s[1:])
        if given:
            pairs = (c if KIND(y) in "xf" else min(c, NOVEL) for c, y in zip(pairs, s[1:], strict=False))
        return sum(pairs) + NOVEL * left

    def _search(self, run: str, before: str = " ", after: str = " ") -> tuple[str, tuple[str, ...]]:
        """The cheapest reachable text of a run and the operations that lead to it; none if nothing is cheaper. A text costs
        at least nothing, so states that could only gain by more operations than the best text costs are left aside."""
        start = self.cost(run, before, after, True)
        best, best_cost, best_ops = run, start, ()
        visited = {hash(run)}
        heap = [(start, 0, run, ())]
        n = 0
        while heap:
            _, _, text, ops = heapq.heappop(heap)
            spent = OP_COST * (len(ops) + 1)
            if spent >= best_cost:
                continue
            for op, t in neighbours(text):
                if (h := hash(t)) in visited:
                    continue
                visited.add(h)
                n += 1
                c = self.cost(t, before, after) + spent
                if c < best_cost:
                    best, best_cost, best_ops = t, c, (*ops, op)
                heapq.heappush(heap, (c, n, t, (*ops, op)))
        return best, best_ops

    def _readings(self, word: str, before: str, after: str) -> tuple[float, tuple[tuple[float, str], ...]]:
        """The most any reading gains, and the cost and the text of a word as it is, then by each of the passage pairs; what
        a pair can't read stays. Where the search over runs has something better than the word as it is, that is its cost,
        and the word is left to it."""
        found, ops = self.search(word, before, after)
        own = self.cost(word, before, after, True)
        out = [(self.cost(found, before, after) + OP_COST * len(ops) if ops else own, word)]
        for a, b in PASSAGE_PAIRS:
            t = undo_single(word, a, b)
            out.append((own + 1.0, word) if t is None else (own, word) if t == word else (self.cost(t, before, after) + WORD_COST, t))
        return out[0][0] - min(c for c, _ in out), tuple(out)


    def _token(self, token: str) -> tuple[bool, tuple[tuple[str, float], ...]]:
        """Whether some run of a token has a cheaper reachable text, and what its words gain at most in a passage."""
        edge = lambda i: symbol(token[i]) if 0 <= i < len(token) else " "
        found = any(self.search(m.group(), edge(m.start() - 1), edge(m.end()))[1] for m in _RUN.finditer(token))
        gains = ((m.group(), self.readings(m.group(), edge(m.start() - 1), edge(m.end()))[0]) for m in _WORD.finditer(token))
        return found, tuple((w, g) for w, g in gains if g > 0)


PRIOR = Plausibility()


def neighbours(text: str) -> list[tuple[str, str]]:
    """``(operation, text)`` one operation away. Each makes the text shorter, so every search ends."""
    out = []
    if "&" in text and (t := html.unescape(text)) != text:
        out.append(("unescape", t))
    if not text.isascii():
        for codec in WRONG_FOR_UTF8:
            if (t := undo_utf8(text, codec)) is not None:
                out.append((f"{codec}>utf-8", t))
        if (t := undo_double_byte(text, "gbk")) is not None:
            out.append(("gbk>utf-8", t))
    return out


def restore_passages(text: str, model: Plausibility) -> tuple[str, list[tuple[str, ...]]]:
    """``text`` with the passages restored that were seen as one code page and written in another, and the pairs used.
    Words that also hold ASCII letters are left as they are."""
    words = [(m.start(), m.group()) for m in _WORD.finditer(text)]
    words = [(a, w) for a, w in words if not (a and _letter(text[a - 1]) or a + len(w) < len(text) and _letter(text[a + len(w)]))]
    if not words:
        return text, []
    edge = lambda i: symbol(text[i]) if 0 <= i < len(text) else " "
    found = [model.readings(w, edge(a - 1), edge(a + len(w))) for a, w in words]
    gains: dict[str, float] = {}
    for (_, w), (gain, _) in zip(words, found, strict=True):
        gains.setdefault(w, gain)
    if sum(gains.values()) <= ENTER_COST:  # no path can gain more
        return text, []
    readings = []
    told: set[str] = set()
    for (_, w), (_, r) in zip(words, found, strict=True):
        # a word that is there again is no further evidence for a passage, only against one
        readings.append(tuple((max(c, r[0][0]), t) for c, t in r) if w in told else r)
        told.add(w)
    n = len(PASSAGE_PAIRS) + 1
    total = [0.0] + [ENTER_COST] * (n - 1)
    came: list[list[int]] = []
    for i, r in enumerate(readings):
        if i:
            best = min(range(n), key=total.__getitem__)
            step = []
            for s in range(n):
                via = total[best] + (ENTER_COST if s else LEAVE_COST)
                step.append(best if via < total[s] or s == 0 and via == total[s] else s)  # of equal paths the longest passage
                total[s] = min(via, total[s])
            came.append(step)
        for s in range(n):
            total[s] += r[s][0]
    s = min(range(n), key=total.__getitem__)
    path = [s]
    for step in reversed(came):
        s = step[s]
        path.append(s)
    path.reverse()
    out, at, used = [], 0, set()
    for (a, w), r, s in zip(words, readings, path, strict=True):
        if r[s][1] != w:
            out += [text[at:a], r[s][1]]
            at = a + len(w)
            used.add(f"{PASSAGE_PAIRS[s - 1][0]}>{PASSAGE_PAIRS[s - 1][1]}")
    return "".join(out) + text[at:], [(u,) for u in sorted(used)]


def _letter(c: str) -> bool:
    return c.isascii() and c.isalpha()


def _apply(run: str, ops: tuple[str, ...]) -> str | None:
    for op in ops:
        a = op.partition(">")[0]
        t = html.unescape(run) if op == "unescape" else undo_double_byte(run, a) if a == "gbk" else undo_utf8(run, a)
        if t is None or t == run:
            return None
        run = t
    return run


def _restore_runs(text: str, model: Plausibility) -> tuple[str, list[tuple[str, ...]]]:
    runs = [(m.start(), m.end(), m.group()) for m in _RUN.finditer(text)]
    near = lambda a, b: (symbol(text[a - 1]) if a else " ", symbol(text[b]) if b < len(text) else " ")
    fixes: dict[int, str] = {}
    chains: dict[tuple[str, ...], int] = {}
    for i, (a, b, run) in enumerate(runs):
        fixed, ops = model.search(run, *near(a, b))
        if ops and ops != ("unescape",):
            fixes[i] = fixed
            chains[ops] = chains.get(ops, 0) + 1
    if not fixes:
        return text, []
    order, n = sorted(chains, key=lambda k: (-chains[k], k)), sum(chains.values())
    for i, (a, b, run) in enumerate(runs):
        # a chain that is rare in the document has to be better by as much
        best, best_cost = run, model.cost(run, *near(a, b), True) if i not in fixes else math.inf
        for chain in order:
            t = _apply(run, chain)
            if t is not None and (c := model.cost(t, *near(a, b)) + math.log(n / chains[chain])) < best_cost:
                best, best_cost = t, c
        if best != run:
            fixes[i] = best
    out, at = [], 0
    for i in sorted(fixes):
        out.append(text[at : runs[i][0]])
        out.append(fixes[i])
        at = runs[i][1]
    return "".join(out) + text[at:], sorted(chains)


def restore(text: str, model: Plausibility | None = None) -> tuple[str, list[str], int]:
    """``(text restored as far as can be, chains of operations used, replacement characters left)``; without a model by
    the prior alone."""
    model = model or PRIOR
    if "&" not in text:  # most texts are told to be sound by their tokens
        gains: dict[str, float] = {}
        for token in set(_TOKEN.findall(text)):
            found, words = model.token(token)
            if found:
                break
            for w, g in words:
                gains[w] = max(g, gains.get(w, 0.0))
        else:
            if sum(gains.values()) <= ENTER_COST:
                return text, [], text.count("�")
    fixed, before = restore_passages(text, model)
    fixed, chains = _restore_runs(fixed, model)
    fixed, after = restore_passages(fixed, model) if chains else (fixed, [])
    return fixed, ["+".join(c) for c in sorted({*before, *chains, *after})], text.count("�")


def _count_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    n: Counter = Counter()
    for pdf in batches:
        n.update(count_pairs(pdf["text"]))
    yield pd.DataFrame({"pair": pd.Series(list(n), dtype=object), "n": pd.Series(list(n.values()), dtype="int64")})


def pair_counts(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``(pair, n)``: the number of texts that hold each pair of symbols, over all texts; see :func:`count_pairs`. Each task
    adds up its own, so few rows are shuffled."""
    text = F.col(text_col).cast("string")
    return df.select(text.alias("text")).filter(F.col("text").rlike(r"[^\x00-\x7F]")).mapInPandas(_count_batches, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))


def _restorer(counts):
    """A batch function; the model is made once per Python worker from the broadcast counts."""

    def run(text: pd.Series) -> pd.DataFrame:
        model = once(("plausibility", counts.id), lambda: Plausibility(counts.value))
        rows = [(None, [], 0) if t is None else restore(t, model) for t in text]
        return pd.DataFrame(rows, columns=["text", "chains", "lost"])

    return run


def restore_encoding(df: DataFrame, text_col: str = "text", prefix: str = "restored", counts: DataFrame | None = None) -> DataFrame:
    """``df`` with ``{prefix}_text`` (null stays null), ``{prefix}_chains`` (operations used, an empty array where the
    text is sound), ``{prefix}_lost`` (characters that are gone for good) and ``{prefix}_affected``.

    A text is affected if some run has a cheaper reachable text or holds a replacement character. ``counts`` is a table
    ``(pair, n)`` of :func:`pair_counts`, by default that of ``df``: fewer than 2,500 symbols, so it has a bound, and is
    broadcast. Only texts that meet what every operation needs go to Python; all others are sound as they are. Whole
    texts are searched, of any length; rows are neither dropped nor added. Columns of these names are replaced.
    """
    spark = df.sparkSession
    found = {r["pair"]: r["n"] for r in (pair_counts(df, text_col) if counts is None else counts).collect()}
    model = Shared(spark, found)
    text = F.col(text_col).cast("string")
    udf = F.pandas_udf(_restorer(model), "text string, chains array<string>, lost int")
    r = udf(F.when(text.rlike(NEEDED), text))
    keep = [c for c in df.columns if c not in {f"{prefix}_{x}" for x in ("text", "chains", "lost", "affected")}]
    out = df.select(*[F.col(c) for c in keep], text.alias("__cz_t"), r.alias("__cz_r"))
    chains = F.coalesce("__cz_r.chains", F.array().cast("array<string>"))
    lost = F.coalesce("__cz_r.lost", F.lit(0))
    return out.select(
        *keep,
        F.coalesce("__cz_r.text", "__cz_t").alias(f"{prefix}_text"),
        chains.alias(f"{prefix}_chains"),
        lost.alias(f"{prefix}_lost"),
        ((F.size(chains) > 0) | (lost > 0)).alias(f"{prefix}_affected"),
    )
