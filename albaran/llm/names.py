"""Variant spellings of names typed by people.

Suffix blocking: all token suffixes from a minimum length on are the index; a trade or given name is a key, too, for
tokens whose end is misread. A key that too many names share (``common``) is refined with the other fields of the name
first, and only then discarded: the shortest suffix and the fields have refined keys, and of a longer suffix the names
are among those of its end. So every name keeps its keys, but a pair that has nothing but common keys in common, and none
of the refined ones, is not compared; the README has the measured loss. The names of a block are compared where they meet,
by the longest-common-subsequence ratio of their tokens; pairs that can't reach it are passed over by exact bounds. Beside the fixed lists of trades and given names, words that stand
beside many different ones are learned from the corpus: two names with different ones are not one supplier's. Spellings whose tokens are all written out are joined into
classes first; spellings with initials or a missing family name then join the class they fit, if at least three quarters of the
written-out spellings they fit are of one class.

Defined results: NULL, empty and blank names, and names without a readable token, are in no pair; repeated names count
once; the pair order is by code points.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from albaran.llm.graph import components
from albaran.session import cut, ship, spread

# Legal forms, written without points and accents.
LEGAL = """
sa sac saa sl slu srl srltda sarl sas ltd ltda limited limitada llc inc incorporated corp gmbh bv nv ag kg spa eirl plc co company
sociedad anonima cerrada responsabilidad limitada gesellschaft mbh hijos fils sohne sons
""".split()
# Words before or beside a name that say nothing about whose it is.
EMPTY_WORDS = """
proveedor supplier vendor razon social empresa cia compania grupo group the sr sra srta dr dra mr mrs ms don dona herr frau sig senhor
de del la el los las and und et of para fornecedor fournisseur lieferant fornitore leverancier nombre name firma
""".split()
# Trades, each with its common short forms.
TRADES = """
logistica: log logist
materiales: mat mater
engineering: engrg eng engr engg
graficas: graf
papelera: pap papel
vehicles: veh vehic
uniformes: unif
technologies: tech technol
ferreteria: ferret ferr
equipos: eq equip
quimica: quim
ingenieria: ing ingen
distribuciones: distrib distr dist
hydraulics: hydr hydraul
electricidad: elect elec electr
werkzeuge: werkz
manufacturing: mfg manuf
suministros: sumin sum
supplies: suppl
construcciones: constr const
packaging: pkg packag
iluminacion: ilum
transportes: transp trans
catering: cat cater
building materials: bldg mat, building mat, bldg materials, bm, bldg
obras civiles: oocc, oo cc, obras civ, ob civ
"""
# Given names and their short and pet forms.
GIVEN = """
jose: pepe jos pepito
francisco: paco pancho fco frco kiko curro
enrique: quique kike enr
roberto: beto robert bob rob
guillermo: memo guille gmo willy
dolores: lola loli lolita
isabel: isa chabela isabela chabe bel
ursula: ursel uschi uschi ulla
hendrik: henk rik hein henry
viktoria: vika vicky vickie vicki viktorija victoria
william: bill will billy wm liam
margaret: peggy maggie meg marge madge greta marga
nicolas: nico nick colas
antonio: tono toni tony anton ant
catherine: cathy kate katie cath kathy
ludovico: vico ludo lodo lodovico
maria: mari ma maruja
juan: juanito
luis: lucho
manuel: manolo manu
alberto: berto
rosario: charo
consuelo: chelo
concepcion: concha conchita
mercedes: merche
eduardo: lalo edu
ignacio: nacho
jesus: chucho chuy
rafael: rafa
alejandro: alex
elizabeth: liz beth betty eliza
robert: bob rob bobby
richard: dick rick
thomas: tom
johannes: hans jan
wilhelm: willi
giuseppe: beppe peppe
giovanni: gianni
"""


def fold(s: str) -> str:
    s = "".join(c for c in unicodedata.normalize("NFKD", s.lower()) if not unicodedata.combining(c))
    return s.replace("ß", "ss").replace("ø", "o").replace("ł", "l")


def _table(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in text.strip().split("\n"):
        name, _, short = line.partition(":")
        out[name] = name
        parts = [x.strip() for x in short.split(",")] if "," in short else short.split()
        for x in parts:
            out.setdefault(x, name)
    return out


TRADE_OF, GIVEN_OF = _table(TRADES), _table(GIVEN)
LEGAL_SET, EMPTY_SET = frozenset(LEGAL), frozenset(EMPTY_WORDS)
LONE_TRADES = sorted({t for t in TRADE_OF.values() if " " not in t})
TWO_WORD_TRADES = sorted({t for t in TRADE_OF.values() if " " in t})
#: Single digits that stand for an initial.
DIGIT_INITIALS = {"1": "i", "5": "s", "8": "b", "0": "o"}
LONG_LEGAL = [x for x in LEGAL if len(x) >= 6]
LONG_EMPTY = [x for x in EMPTY_WORDS if len(x) >= 6]


@lru_cache(maxsize=200_000)
def lcs_ratio(a: str, b: str) -> float:
    """2 LCS / (|a| + |b|), the LCS by bit-parallel rows."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & where.get(c, 0)
        v = (v + u | v - u) & full
    return 2 * (len(a) - v.bit_count()) / (len(a) + len(b))


def _mend(w: str) -> str:
    """Digits read for letters inside a word."""
    if any(c.isalpha() for c in w) and any(c in "01589" for c in w):
        w = w.translate(str.maketrans("0158", "olsb"))
    return w


class Name:
    """A parsed name: trades, given names, initials and the other tokens (family or company words)."""

    __slots__ = ("trade", "given", "initials", "core", "weak", "vague")

    def __init__(self, raw: str):
        s = re.sub(r"\([^)]*\)?", " ", raw)
        s = fold(s)
        s = re.sub(r"[&+]", " ", s)
        s = re.sub(r"\b([a-z0-9])\.(?=\s?[a-z0-9]\b)", r"\1", s)  # s.r.l. -> srl.
        s = re.sub(r"\b(s) a r l\b|\bs\.? a r\.?l\b", "sarl", s)
        s = re.sub(r"\b([a-z]{2,6})\.([a-z]{1,2})\b", r"\1\2", s)  # a point that slipped in before the last letters
        s = re.sub(r"[^a-z0-9]+", " ", s)
        words = [_mend(w) for w in s.split()]
        words = [DIGIT_INITIALS.get(w, w) for w in words if not w.isdigit() or w in DIGIT_INITIALS]
        self.trade: set[str] = set()
        self.given: set[str] = set()
        self.initials: list[str] = []
        self.core: list[str] = []
        rest = self._known(words)
        legal = any(w in LEGAL_SET for w in words)
        if legal and len(rest) > 1 and rest[-1] == words[-1] and any(x.startswith(rest[-1]) for x in LONG_LEGAL):
            rest = rest[:-1]  # a legal form cut off at the end
        if not self.trade:
            rest = self._mistyped_trade(rest)
        if self.given and (self.trade - {"ingenieria"} or self.trade and "ing" not in words):
            rest = [w for w in words if GIVEN_OF.get(w) in self.given or w in rest]  # a company's word
            self.given = set()
        elif self.given:
            self.trade = set()  # the title of a person
        mended = [self._short_trade, self._mistyped_given] if legal else [self._mistyped_given, self._short_trade]
        for mend in mended:
            if not self.trade and not self.given and (mend != self._short_trade or not self.initials):
                rest = mend(rest)
        rest = [w for w in rest if not (len(w) <= 5 and not any(c in "aeiouy" for c in w))]
        if self.trade and len(rest) > 1:
            rest = self._late_legal(rest)
        if len(rest) > 1 and words[0] == rest[0] and any(lcs_ratio(rest[0], x) >= 0.8 for x in ("grupo", "group", "empresa", "proveedor", "supplier")):
            rest = rest[1:]
        self.core = rest
        self._judge()

    def _judge(self) -> None:
        self.vague = not self.trade and not self.given and not self.initials
        self.weak = self.vague or not self.trade and (bool(self.initials) or len(self.core) < 2)

    def _known(self, words: list[str]) -> list[str]:
        """Takes out what is written right; the other words."""
        rest: list[str] = []
        i, n = 0, len(words)
        while i < n:
            w, two = words[i], " ".join(words[i : i + 2])
            if two in TRADE_OF or i + 1 < n and len(two) >= 10 and self._near(two, TWO_WORD_TRADES, 0.85):
                self.trade.add(TRADE_OF.get(two) or self._near(two, TWO_WORD_TRADES, 0.85))
                i += 2
                continue
            i += 1
            if w in LEGAL_SET or w in EMPTY_SET:
                continue
            if w in TRADE_OF:
                self.trade.add(TRADE_OF[w])
            elif w in GIVEN_OF:
                self.given.add(GIVEN_OF[w])
            elif len(w) == 1:
                self.initials.append(w)
            elif len(w) >= 5 and self._near(w, LONG_LEGAL + LONG_EMPTY, 0.83):
                continue
            else:
                rest.append(w)
        if {"materiales", "building materials"} <= self.trade:
            self.trade.discard("materiales")
        return rest

    def _mistyped_trade(self, rest: list[str]) -> list[str]:
        best = (0.0, "", "")
        for w in rest:
            own = max(lcs_ratio(w, g) for g in GIVEN_OF)
            if len(w) >= 5 and own > max(lcs_ratio(w, x) for x in LONE_TRADES):
                continue  # rather a given name
            if len(w) >= 5 and not self.given:
                t = max(LONE_TRADES, key=lambda x: lcs_ratio(w, x))
                best = max(best, (lcs_ratio(w, t), w, t))
            if len(w) >= 4 and not self.given:
                t = max((x for x in TRADE_OF if len(x) >= 4 and " " not in x), key=lambda x: lcs_ratio(w, x))
                best = max(best, (lcs_ratio(w, t) - 0.04, w, t))
        if best[0] < 0.8:
            return rest
        self.trade.add(TRADE_OF[best[2]])
        return [w for w in rest if w != best[1]]

    def _mistyped_given(self, rest: list[str]) -> list[str]:
        """A given name with a slip: same first letter, or the whole word but one letter."""
        best = (0.0, "", "")
        for w in rest:
            if len(w) >= 4:
                for g in GIVEN_OF:
                    r = lcs_ratio(w, g)
                    if len(g) >= 4 and r >= (0.75 if g[0] == w[0] and len(rest) > 2 else 0.83):
                        best = max(best, (r, w, g))
        if not best[0] or len(rest) < 2:
            return rest
        self.given.add(GIVEN_OF[best[2]])
        return [w for w in rest if w != best[1]]

    def _short_trade(self, rest: list[str]) -> list[str]:
        """A mistyped short form of a trade, if the name has nothing else."""
        best = max(((lcs_ratio(w, t), w, t) for w in rest if 3 <= len(w) <= 6 for t in TRADE_OF if 3 <= len(t) <= 8), default=(0, "", ""))
        if best[0] < 0.75 or len(rest) < 2:
            return rest
        self.trade.add(TRADE_OF[best[2]])
        return [w for w in rest if w != best[1]]

    @staticmethod
    def _late_legal(rest: list[str]) -> list[str]:
        """Without a mistyped legal form beside the company's words."""
        for w in rest:
            if 3 <= len(w) <= 9 and any(w[0] == x[0] and lcs_ratio(w, x) >= 0.75 or sorted(w) == sorted(x) for x in LEGAL if len(x) >= 4):
                return [x for x in rest if x != w]
        return rest

    @staticmethod
    def _near(w: str, words: list[str], least: float) -> str | None:
        best = max(words, key=lambda x: lcs_ratio(w, x))
        return best if lcs_ratio(w, best) >= least else None


@lru_cache(maxsize=100_000)
def parse(raw: str) -> Name:
    return Name(raw)


def _align(left: list[str], right: list[str], least: float) -> tuple[float, float, list[str], list[str]]:
    """Best pairs of tokens first: matched weight, matched length, the tokens left over on both sides."""
    pairs = []
    for i, x in enumerate(left):
        for j, y in enumerate(right):
            r = lcs_ratio(x, y)
            short, long_, last = (x, y, i == len(left) - 1) if len(x) < len(y) else (y, x, j == len(right) - 1)
            if last and len(short) >= 2 and long_.startswith(short):
                r = max(r, 0.85)  # cut off at the end
            pairs.append((r, i, j))
    pairs.sort(reverse=True)
    used_l: set[int] = set()
    used_r: set[int] = set()
    weight = total = 0.0
    for r, i, j in pairs:
        if r < least:
            break
        if i in used_l or j in used_r:
            continue
        used_l.add(i)
        used_r.add(j)
        size = len(left[i]) + len(right[j])
        weight += r * size
        total += size
    return weight, total, [x for i, x in enumerate(left) if i not in used_l], [x for j, x in enumerate(right) if j not in used_r]


def similarity(a: Name, b: Name, least_token: float = 0.6) -> float:
    """0 where the names can't be one supplier's, else the length-weighted LCS ratio of their aligned tokens."""
    if not a.core or not b.core:
        return 0.0
    if a.vague != b.vague and (a.trade or b.trade):
        # a name without a readable trade: all words of the other, and at most one short word more
        full, part = (b, a) if a.vague else (a, b)
        weight, total, rest, more = _align(full.core, part.core, least_token)
        fine = total and not rest and len(more) <= 1 and all(len(x) <= 6 for x in more)
        return weight / total if fine else 0.0
    if a.trade != b.trade:
        return 0.0
    company = bool(a.trade)
    left, right = list(a.core), list(b.core)
    ia, ib = list(a.initials), list(b.initials)
    named = bool(a.given and b.given)
    if not company:
        if a.given and b.given:
            if not a.given & b.given:
                return 0.0
        elif a.given or b.given:
            (one, initials, other) = (a.given, ib, right) if a.given else (b.given, ia, left)
            hit = next((x for x in initials if any(g[0] == x for g in one)), None)
            if hit:
                initials.remove(hit)
            else:  # a mistyped given name among the other tokens
                best = max(((lcs_ratio(t, g), t) for t in other for g in one), default=(0, ""))
                if best[0] < 0.7:
                    return 0.0
                other.remove(best[1])
                named = True
        elif ia and ib and ia[0] != ib[0]:
            return 0.0
    weight, total, rest_l, rest_r = _align(left, right, least_token)
    if not total:
        return 0.0
    for rest, initials in ((rest_l, ib), (rest_r, ia)):
        for x in list(rest):
            hit = next((k for k in initials if x[0] == k), None)
            if hit:
                initials.remove(hit)
                rest.remove(x)
    if rest_l and rest_r:
        if company and lcs_ratio("".join(sorted(left)), "".join(sorted(right))) >= 0.85 and lcs_ratio("".join(left), "".join(right)) >= 0.85:
            return 0.85
        return 0.0
    rest = rest_l or rest_r
    if rest:
        if company:
            if lcs_ratio("".join(left), "".join(right)) < 0.85:
                return 0.0
        elif len(rest) > 1 or not named and not (a.initials or b.initials):
            return 0.0
    return weight / total


def conflict(a: Name, b: Name) -> bool:
    """Another trade, given name or family name: never one supplier."""
    if a.trade and b.trade and a.trade != b.trade or a.trade and b.given or b.trade and a.given:
        return True
    if not a.trade and a.given and b.given and not a.given & b.given:
        return True
    _, total, _, _ = _align(a.core, b.core, 0.55)
    return total < 0.6 * 2 * min(sum(map(len, a.core)), sum(map(len, b.core)))


@lru_cache(maxsize=100_000)
def _common_word(x: str, learned: frozenset[str]) -> str | None:
    """The learned word that x is, or is a slip of."""
    if x in learned or len(x) < 4:
        return x if x in learned else None
    near = max((w for w in learned if w[0] == x[0] and abs(len(w) - len(x)) <= 2), key=lambda w: (lcs_ratio(x, w), w), default="")
    return near if lcs_ratio(x, near) >= 0.85 else None


def other_words(a: Name, b: Name, learned: frozenset[str]) -> bool:
    """Does each of two names without a known trade or given name have a common word of the corpus that the other lacks?

    Common words stand beside many different ones, as trades do. A slip or a cut-off form is the same word.
    """
    if not learned or not (a.vague and b.vague):
        return False
    same = lambda x, y: lcs_ratio(x, y) >= 0.8 or min(len(x), len(y)) >= 3 and (x.startswith(y) or y.startswith(x))
    lone = lambda p, q: any((w := _common_word(x, learned)) and not any(same(x, y) or same(w, y) for y in q.core) for x in p.core)
    return lone(a, b) and lone(b, a)


def block_keys(n: Name, shortest: int = 4, head: int = 3) -> list[tuple[str, str | None]]:
    """(index key, refined key) of a name. The first is a token suffix or a common field; the second adds other fields.

    Suffixes above the shortest length have no refined key: those of their end are finer already.
    """
    fields = sorted(n.trade) or sorted(n.given) or [x for x in n.initials[:1]]
    field = fields[0] if fields else ""
    out = []
    for t in n.core:
        tail = t[-shortest:] if len(t) >= shortest else t
        out.append((f"s:{tail}", f"s:{tail}|{field[:1]}|{'t' if n.trade else 'g'}{t[:1]}"))
        out.append((f"s:{tail}", f"s:{tail}|{field}"))
        out.append((f"s:{tail}", f"s:{tail}|*{t[:2]}"))  # for names whose other fields can't be read
        out += [(f"s:{t[i:]}", None) for i in range(len(t) - shortest)]
        out.append((f"f:{field}", f"f:{field}|{t[: head - 1]}"))
        out.append((f"f:{field}", f"f:{field[:1]}|{t[:head]}"))
    if len(n.core) > 1:
        whole = "".join(sorted(n.core))
        out.append((f"f:{field}", f"f:{field}|{whole[:4]}|{len(n.core)}"))
    return list(dict.fromkeys(out))


def _told(n: Name) -> str:
    """A parsed name in one string: names are parsed once, and every later stage reads this."""
    return "\t".join([",".join(sorted(n.trade)), ",".join(sorted(n.given)), ",".join(n.initials), ",".join(n.core)])


@lru_cache(maxsize=100_000)
def _read(told: str) -> Name:
    n = object.__new__(Name)
    trade, given, initials, core = (x.split(",") if x else [] for x in told.split("\t"))
    n.trade, n.given, n.initials, n.core = set(trade), set(given), initials, core
    n._judge()
    return n


def _parse_udf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        yield pd.DataFrame({"name": b["name"], "told": [_told(parse(x)) for x in b["name"]]})


def parsed(names: DataFrame) -> DataFrame:
    """(name, told) of distinct names, each parsed once. names: (name), or what this gives."""
    if "told" in names.columns:
        return names
    ship(names.sparkSession)
    return cut(spread(cut(names.select("name"))).mapInPandas(_parse_udf, "name string, told string"))


def _keys_udf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for name, told in zip(b["name"], b["told"]):
            keys: dict[str, list[str]] = {}
            for k, r in block_keys(_read(told)):
                keys.setdefault(k, []).extend([r] if r else [])
            rows += [(name, told, k, r) for k, r in keys.items()]
        yield pd.DataFrame(rows, columns=["name", "told", "key", "refined"])


LETTERS = {c: i for i, c in enumerate("abcdefghijklmnopqrstuvwxyz0123456789")}


class Filter:
    """Which pairs of a frame's names can reach `least` at all: exact bounds of ``similarity``, for many pairs at once.

    A score is a mean of token ratios, so one pair of tokens has to reach it, or be a word and its cut-off form, or the
    letters of all words of two companies have to be alike. Trades and given names that differ end it before.
    """

    def __init__(self, names: list[Name], least: float):
        self.least = least - 1e-9
        code: dict[tuple, int] = {(): 0}
        number = lambda xs: np.array([code.setdefault(tuple(sorted(x)), len(code)) for x in xs])
        self.trade, self.given = number(n.trade for n in names), number(n.given for n in names)
        self.one_given = np.array([len(n.given) == 1 for n in names])
        self.vague = np.array([n.vague for n in names])
        tokens: dict[str, int] = {}
        lists = [[tokens.setdefault(t, len(tokens)) for t in n.core] for n in names]
        self.many = np.array([len(x) for x in lists])
        self.first = np.cumsum(self.many) - self.many
        self.token = np.array([t for x in lists for t in x])
        words = list(tokens)
        self.size = np.array([len(w) for w in words])
        width = min(63, int(self.size.max(initial=1)))
        self.counts = np.zeros((len(words), len(LETTERS)), np.int16)
        self.letters = np.zeros((len(words), width), np.int64)
        self.masks = np.zeros((len(words), len(LETTERS)), np.uint64)
        for i, w in enumerate(words):
            at = [LETTERS[c] for c in w]
            np.add.at(self.counts[i], at, 1)
            for k, c in enumerate(at[:width]):
                self.letters[i, k] = c
                self.masks[i, c] |= np.uint64(1 << k)
        head = {x: i for i, x in enumerate({w[:2] for w in words})}
        self.head = np.array([head[w[:2]] for w in words])
        self.all_counts = np.add.reduceat(self.counts[self.token], self.first, axis=0)
        self.all_size = np.add.reduceat(self.size[self.token], self.first)

    def _lcs(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """LCS of pairs of tokens of up to 63 letters, by bit-parallel rows."""
        full = (np.uint64(1) << self.size[x].astype(np.uint64)) - np.uint64(1)
        v = full.copy()
        for k in range(int(self.size[y].max(initial=0))):
            u = v & self.masks[x, self.letters[y, k]]
            v = np.where(k < self.size[y], (v + u | v - u) & full, v)
        return self.size[x] - np.bitwise_count(v)

    def _near(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Tokens whose ratio can count as `least`."""
        short, both = np.minimum(self.size[x], self.size[y]), self.size[x] + self.size[y]
        common = np.minimum(self.counts[x], self.counts[y]).sum(axis=1)
        hit = (common == short) & (self.head[x] == self.head[y])
        maybe = np.flatnonzero(~hit & (2 * common >= self.least * both))
        long_ = np.maximum(self.size[x[maybe]], self.size[y[maybe]]) > 63
        hit[maybe[long_]] = True
        maybe = maybe[~long_]
        hit[maybe[2 * self._lcs(x[maybe], y[maybe]) >= self.least * both[maybe]]] = True
        return hit

    def __call__(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """The numbers of the pairs that are left."""
        tp, tq = self.trade[p], self.trade[q]
        fine = np.where((self.vague[p] != self.vague[q]) & ((tp > 0) | (tq > 0)), True, tp == tq)
        fine &= (tp > 0) | (tq > 0) | ~(self.one_given[p] & self.one_given[q]) | (self.given[p] == self.given[q])
        left = np.flatnonzero(fine)
        p, q = p[left], q[left]
        n = self.many[p] * self.many[q]
        pair = np.repeat(np.arange(len(left)), n)
        spot = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n)
        wide = self.many[q][pair]
        x, y = self.token[self.first[p][pair] + spot // wide], self.token[self.first[q][pair] + spot % wide]
        hit = np.zeros(len(left), bool)
        hit[pair[self._near(x, y)]] = True
        firm = np.flatnonzero(~hit & (self.trade[p] > 0) & (self.trade[p] == self.trade[q]))
        a, b = p[firm], q[firm]
        hit[firm] = 2 * np.minimum(self.all_counts[a], self.all_counts[b]).sum(axis=1) >= (0.85 - 1e-9) * (self.all_size[a] + self.all_size[b])
        return left[hit]


def _pairs(block: np.ndarray, most: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows of one block, some `most` at once. block: sorted."""
    ends = np.searchsorted(block, block, side="right")
    rows = np.arange(len(block))
    n = ends - rows - 1
    upto = np.cumsum(n)
    start = 0
    while start < len(block):
        stop = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + most, side="right")))
        mine = n[start:stop]
        p = np.repeat(rows[start:stop], mine)
        if len(p):
            yield p, p + 1 + np.arange(len(p)) - np.repeat(np.cumsum(mine) - mine, mine)
        start = stop


def _whole_blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames of whole blocks: rows come sorted by block, and a block may go over several batches."""
    left: list[pd.DataFrame] = []
    for b in batches:
        if not len(b):
            continue
        block = b["block"].to_numpy()
        last = int(np.searchsorted(block, block[-1]))  # where the block that may go on starts
        if last or left and left[-1]["block"].iat[-1] != block[0]:
            yield pd.concat([*left, b.iloc[:last]], ignore_index=True)
            left = [b.iloc[last:]]
        else:
            left.append(b)
    if left:
        yield pd.concat(left, ignore_index=True)


def _score(learned: frozenset[str], least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _whole_blocks(batches):
            block, rows = b["block"].to_numpy(), []
            many = np.ones(len(b), bool)
            many[:-1] = block[1:] == block[:-1]
            many[1:] |= block[1:] == block[:-1]
            many[0] = len(b) > 1 and block[0] == block[1]
            block, name, told = block[many], b["name"].to_numpy()[many], b["told"].to_numpy()[many]
            if not len(block):
                continue
            names = [_read(t) for t in told]
            can = Filter(names, least)
            for i, j in _pairs(block):
                for k in can(i, j):
                    (x, p), (y, q) = sorted(((name[m], names[m]) for m in (i[k], j[k])), key=lambda z: z[0])
                    score = 0.0 if other_words(p, q, learned) else similarity(p, q)
                    if score >= least and x != y:
                        rows.append((x, y, score, p.weak or q.weak, p.weak, q.weak))
            yield pd.DataFrame(rows, columns=["name_a", "name_b", "score", "weak", "weak_a", "weak_b"])

    return run


def _same(learned: frozenset[str]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            told = zip(map(_read, b["told_a"]), map(_read, b["told_b"]))
            yield b.loc[[not conflict(p, q) and not other_words(p, q, learned) for p, q in told], ["name_a", "name_b"]]

    return run


def _words_udf(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for told in b["told"]:
            n = _read(told)
            if n.vague and len(n.core) > 1:
                rows += [(w, " ".join(x for x in n.core if x != w)) for w in set(n.core) if len(w) >= 4]
        yield pd.DataFrame(rows, columns=["word", "beside"])


def learned_words(names: DataFrame, least: int = 20) -> frozenset[str]:
    """Words of names without a known trade or given name that stand beside many different ones, learned from all names.

    A word counts from `least` different companions on, and from a 5,000th of all (name, word) pairs, so that there are
    at most 5,000 such words, whatever the corpus.
    """
    pairs = parsed(names).mapInPandas(_words_udf, "word string, beside string").distinct()
    counts = cut(pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    return frozenset(r["word"] for r in counts.where(F.col("n") >= max(least, total / 5_000)).collect())


def scored_pairs(names: DataFrame, learned: frozenset[str], least: float = 0.8, common: int = 60) -> DataFrame:
    """(name_a, name_b, score, weak, weak_a, weak_b): the pairs that share a block and reach `least`. names: (name), distinct.

    An index key that more than `common` names share is replaced by its refined keys; a refined block that is still as
    large is compared whole. The names of a block meet in one task, so pairs are never written: what goes to disk grows
    as the names do, and only pairs that reach `least` come out.
    """
    # Keys and blocks are hashes: two that fall together are only compared together.
    keyed = parsed(names).mapInPandas(_keys_udf, "name string, told string, key string, refined array<string>")
    keyed = keyed.withColumns({"key": F.xxhash64("key"), "refined": F.transform("refined", lambda r: F.xxhash64(r))})
    # A name has a key once; the sizes come from a map-side combined count.
    hot = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where(F.col("size") > common).select("key", F.lit(True).alias("hot"))
    block = keyed.join(hot, "key", "left").select("name", "told", F.explode(F.when(F.col("hot"), F.array_distinct("refined")).otherwise(F.array("key"))).alias("block"))
    kinds = "name_a string, name_b string, score double, weak boolean, weak_a boolean, weak_b boolean"
    return block.repartition("block").sortWithinPartitions("block").mapInPandas(_score(learned, least), kinds).distinct()


def variant_classes(names: DataFrame, least: float = 0.8, common: int = 60, learned: frozenset[str] | None = None) -> DataFrame:
    """(name, cls) of all spellings that are linked with another one. learned: as learned_words gives them, which is the default."""
    names = parsed(names)
    learned = learned_words(names) if learned is None else learned
    scored = cut(scored_pairs(names, learned, least, common))
    strong = components(scored.where(~F.col("weak")).select(F.col("name_a").alias("src"), F.col("name_b").alias("dst")))
    strong = strong.select(F.col("node").alias("name"), F.col("component").alias("cls"))
    # Spellings that are not written out: to the class of the written-out names they fit.
    half = scored.where("weak").select(F.col("name_a").alias("w"), F.col("name_b").alias("o"), F.col("weak_a").alias("ww"), F.col("weak_b").alias("ow"))
    both = half.union(half.select(F.col("o"), F.col("w"), F.col("ow"), F.col("ww"))).where("ww").distinct()
    known = both.where(~F.col("ow")).join(strong.withColumnRenamed("name", "o"), "o", "left").select("w", F.coalesce("cls", "o").alias("cls"))
    votes = known.groupBy("w", "cls").agg(F.count(F.lit(1)).alias("n"))
    fits = votes.groupBy("w").agg(F.max_by("cls", F.struct("n", "cls")).alias("cls"), F.max("n").alias("most"), F.sum("n").alias("all"))
    joined = fits.where("most >= 0.75 * all").select(F.col("w").alias("name"), "cls")
    # Two spellings that are both not written out and fit no written-out name are linked with each other.
    free = both.where("ow").join(fits.select("w"), "w", "left_anti").join(fits.select(F.col("w").alias("o")), "o", "left_anti")
    alone = components(free.select(F.col("w").alias("src"), F.col("o").alias("dst"))).select(F.col("node").alias("name"), F.col("component").alias("cls"))
    reps = joined.select(F.col("cls").alias("name"), "cls").distinct().join(strong.select("name"), "name", "left_anti")
    return strong.unionByName(joined).unionByName(alone).unionByName(reps).distinct()


def variants(names: DataFrame, least: float = 0.8, common: int = 60) -> DataFrame:
    """All pairs (name_a < name_b) of spellings of one supplier. names: a DataFrame with the column name.

    The classes are few spellings each; their pairs are the result asked for. A pair with another trade, given name
    or family name is left out by an exact check at the end.
    """
    clean = names.where(F.col("name").isNotNull() & F.col("name").rlike(r"\p{L}")).select("name").distinct()
    clean = parsed(clean)
    learned = learned_words(clean)
    cls = variant_classes(clean, least, common, learned)
    cls = cut(cls.join(clean, "name"))
    a, b = (cls.withColumnsRenamed({"name": f"name_{x}", "told": f"told_{x}"}) for x in "ab")
    pairs = a.join(b, "cls").where("name_a < name_b").select("name_a", "name_b", "told_a", "told_b")
    return pairs.mapInPandas(_same(learned), "name_a string, name_b string").distinct()
