"""Free-entered values to the entries of a reference list: a trie of the entries and their aliases, searched with a
Levenshtein automaton (insertion, deletion, substitution, transposition of neighbours) within a length-dependent
distance. All entries within the distance are returned (``within``); of a value's code the nearest one counts if it is
one only.

The trie is a sorted list of paths: a node is the range of paths with one beginning, so it takes no more memory than the
paths. Lists of up to ``MOST_ENTRIES`` entries are one trie in each worker; longer ones are taken block by block, each
distinct value against all blocks; the rules and their results are the same for both.

Defined results: NULL and empty values give no row; blank values, values that fit nothing and values that fit several
entries alike give NONE; values of any length are read whole, blanks and words around the currency taken off first.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from albaran.session import cut, ship

# How people write the entries of the currency list.
CURRENCY_ALIASES = """
USD: us dollar, us dollars, american dollar, american dollars, dolar americano, dolares americanos, dolar estadounidense, dolares estadounidenses, dolar usa, dolares usa, dolares de ee.uu., dollar americain, dollars americains, dollaro statunitense, dollari americani, us-dollar, amerikaanse dollar, us$, u$s, usd$
EUR: euro, euros, eur, euros (eur), moneda euro, eur., eu
PEN: sol, soles, nuevo sol, nuevos soles, sol peruano, soles peruanos, peruvian sol, peruvian soles, sols peruviens, s/.
GBP: pound sterling, pounds sterling, sterling, british pound, british pounds, libra esterlina, libras esterlinas, livre sterling, livres sterling, lira sterlina, lire sterline, pfund sterling, gb£
MXN: mexican peso, mexican pesos, peso mexicano, pesos mexicanos, peso mx, pesos mx, peso mex, m.n. (pesos mexicanos), peso mexicain, pesos mexicains, mex$
COP: colombian peso, colombian pesos, peso colombiano, pesos colombianos, peso col., pesos col., peso colombien
ARS: argentine peso, argentine pesos, argentinian pesos, peso argentino, pesos argentinos, peso arg., pesos arg.
CLP: chilean peso, chilean pesos, peso chileno, pesos chilenos, peso chi.
BRL: brazilian real, brazilian reais, brazilian reals, real brasileno, reales brasilenos, real brasileiro, reais brasileiros, reais, real
CAD: canadian dollar, canadian dollars, can. dollar, can. dollars, dolar canadiense, dolares canadienses, dollar canadien, dollars canadiens, ca$, can$
CHF: swiss franc, swiss francs, franco suizo, francos suizos, franc suisse, francs suisses, schweizer franken, franchi svizzeri, franco svizzero, sfr, sfr.
JPY: japanese yen, yen, yens, yenes, yen japones, yenes japoneses, yen japonais, jp¥
BOB: boliviano, bolivianos, bolivian boliviano, bolivian bolivianos, bs.
UYU: uruguayan peso, uruguayan pesos, peso uruguayo, pesos uruguayos, u$
GTQ: quetzal, quetzales, quetzals, quetzal guatemalteco, quetzales guatemaltecos, guatemalan quetzal, guatemalan quetzales
DKK: danish krone, danish kroner, danish krones, corona danesa, coronas danesas, couronne danoise, couronnes danoises, danische krone, danische kronen
SEK: swedish krona, swedish kronor, swedish kronas, corona sueca, coronas suecas, couronne suedoise, couronnes suedoises, schwedische krone, schwedische kronen
PLN: polish zloty, polish zlotys, zloty, zlotys, zloty polaco, zlotys polacos, esloti polaco, eslotis polacos, zloty polonais, zlotys polonais
CNY: yuan renminbi, yuan, yuanes, yuans, chinese yuan, yuan chino, yuanes chinos, yuan chinois, renminbi, rmb, renminbi chino
INR: indian rupee, indian rupees, rupia india, rupias indias, rupias, rupees, rupee, roupie indienne, roupies indiennes, indische rupie, rs., rs. (india), rs (india)
"""
# Words that stand around a currency without naming one.
WRAPPERS = "moneda currency monnaie wahrung valuta divisa moeda pago payment en in de em zahlbar pagar pagadero total precio importe".split()


def fold(s: str) -> str:
    s = "".join(c for c in unicodedata.normalize("NFKD", s.strip().lower()) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", s.replace("ł", "l")).strip()


def allowed(length: int) -> int:
    """Edits that a value of this length may have."""
    return 0 if length <= 3 else 1 if length <= 6 else 2


class Trie:
    """Entries and alias paths, sorted; a node is a range of paths that begin alike."""

    def __init__(self) -> None:
        self.of: dict[str, set[str]] = {}
        self.paths: list[str] | None = None
        self.longest = 0

    def add(self, path: str, entry: str) -> None:
        self.of.setdefault(path, set()).add(entry)
        self.longest = max(self.longest, len(path))
        self.paths = None

    def exact(self, word: str) -> set[str]:
        return self.of.get(word, set())

    def search(self, word: str, most: int) -> dict[str, int]:
        """entry -> least distance, of all entries within `most` edits.

        The automaton's state is the row of distances of the path read so far to the prefixes of the word, clipped at
        most + 1; a path whose row has no value within `most` is left.
        """
        if self.paths is None:
            self.paths = sorted(self.of)
        paths, out, n, over = self.paths, {}, len(word), most + 1
        if n - most > self.longest:
            return out
        first = tuple(min(i, over) for i in range(n + 1))
        stack = [(0, len(paths), 0, "", first, first)]
        while stack:
            low, high, depth, before, row, older = stack.pop()
            if low < high and len(paths[low]) == depth:
                if row[n] <= most:
                    for e in self.of[paths[low]]:
                        out[e] = min(out.get(e, most), row[n])
                low += 1
            while low < high:
                c = paths[low][depth]
                to = bisect_left(paths, chr(ord(c) + 1), low, high, key=lambda p: p[depth])
                new = [min(row[0] + 1, over)]
                for i in range(1, n + 1):
                    best = min(new[i - 1] + 1, row[i] + 1, row[i - 1] + (word[i - 1] != c), over)
                    if before and i > 1 and word[i - 1] == before and word[i - 2] == c:
                        best = min(best, older[i - 2] + 1)
                    new.append(best)
                if min(new) <= most:
                    stack.append((low, to, depth + 1, c, tuple(new), row))
                low = to
        return out


class Rules:
    """The rules for a value. They know the list only by four questions, each with a text, answered by ``ask``: the codes of
    which it is a symbol (s), the code it is (c), the codes of which it is a path (e), those within its distance (n).
    """

    def ask(self, kind: str, text: str) -> dict[str, int]:
        """code -> distance (0 where it is exact)."""
        raise NotImplementedError

    def _symbol(self, text: str) -> set[str]:
        return set(self.ask("s", text))

    def _code(self, text: str) -> set[str]:
        return set(self.ask("c", text))

    def _exact(self, text: str) -> set[str]:
        return set(self.ask("e", text))

    _ahead = re.compile(r"([A-Za-z]{3}) - (?=\S)")

    @staticmethod
    def _one(codes: set[str]) -> str:
        return next(iter(codes)) if len(codes) == 1 else "NONE"

    def _nearest(self, word: str) -> set[str]:
        """The entries at the least distance."""
        if not word:
            return set()
        if hit := self._exact(word):
            return hit
        found = self.ask("n", word) if allowed(len(word)) else {}
        if not found:
            return set()
        near = min(found.values())
        return {c for c, d in found.items() if d == near}

    def _coded(self, word: str) -> set[str]:
        """The code a short word is, points taken out and letters read for look-alikes."""
        w = re.sub(r"[\s.\-_,:;]", "", word).upper()
        if len(w) != 3:
            return set()
        w = w.translate(str.maketrans({"€": "E", "5": "S", "8": "B", "0": "O", "1": "I", "3": "E", "6": "G", "£": "L"})) if not w.isdigit() else w
        return self._code(w)

    def _fits(self, value: str) -> set[str]:
        if hit := self._symbol(value):
            return hit
        s = value.strip()
        if hit := self._symbol(s):
            return hit
        s = " ".join(s.split()).strip(" -:;,")
        if hit := self._symbol(s):
            return hit
        if hit := self._coded(s):
            return hit
        f = fold(s)
        if hit := self._exact(f):
            return hit
        bare = re.sub(r"^\((.*)\)$", r"\1", s).strip()
        lead = re.compile(rf"^(?:(?:{'|'.join(WRAPPERS)})\b\s*:?\s*)+", re.I)
        bare2 = lead.sub("", bare).strip() or bare
        for x in (bare, bare2):
            if hit := self._symbol(x):
                return hit
            for y in (x, x.rstrip(".")):
                if hit := self._coded(y) or self._exact(fold(y)):
                    return hit
        # a code before a dash or at the end: with what is beside it, both must mean the same entry
        coded: set[str] = set()
        rest = bare2
        while True:
            ahead, behind = self._ahead.match(rest), rest.rsplit(" ", 1)
            if ahead and (code := self._code(ahead[1].upper())):
                rest = rest[ahead.end() :]
            elif not ahead and len(behind) == 2 and (code := self._code(behind[1].upper())):
                rest = behind[0]
            else:
                break
            coded |= code
        if coded:
            named = self._fits(rest)
            return coded | named if named else set()
        hit = self._nearest(fold(bare2)) or self._nearest(fold(bare2).rstrip("."))
        if hit:
            return hit
        # a code or symbol beside a name: both must mean the same entry
        words = [w for w in re.split(r"[\s()/]+|(?:\s-\s)", bare2) if w and w != "-"]
        if len(words) > 1:
            coded = [(i, c) for i, w in enumerate(words) if (c := self._code(w.upper()) or self._symbol(w))]
            if coded:
                all_of = set.union(*(c for _, c in coded))
                rest = " ".join(w for i, w in enumerate(words) if i not in {i for i, _ in coded})
                if not re.search(r"\w", rest):
                    return all_of
                named = self._nearest(fold(rest))
                return all_of | named if named else set()
        return set()


class Matcher(Rules):
    """code(value): the entry meant or NONE, of a list that is held whole."""

    def __init__(self, entries: list[tuple[str, str, str]], aliases: str = CURRENCY_ALIASES):
        self.codes = {c for c, _, _ in entries}
        self.symbols: dict[str, set[str]] = {}
        self.trie = Trie()
        for code, name, symbol in entries:
            self.symbols.setdefault(symbol, set()).add(code)
            self.trie.add(fold(name), code)
            self.trie.add(code.lower(), code)
        for line in aliases.strip().split("\n"):
            code, _, paths = line.partition(":")
            if code in self.codes:
                for p in paths.split(","):
                    if p.strip():
                        self.trie.add(fold(p), code)
        self.seen: dict[str, str] = {}

    def ask(self, kind: str, text: str) -> dict[str, int]:
        if kind == "n":
            return self.trie.search(text, allowed(len(text)))
        found = self.symbols.get(text, ()) if kind == "s" else {text} & self.codes if kind == "c" else self.trie.exact(text)
        return dict.fromkeys(found, 0)

    def code(self, value: str) -> str:
        got = self.seen.get(value)
        if got is None:
            if len(self.seen) > 200_000:
                self.seen.clear()
            got = self._one(self._fits(value))
            if len(value) <= 200:
                self.seen[value] = got
        return got


class Told(Rules):
    """The rules on answers given before. What isn't known yet counts as not found, and is noted in ``open``."""

    def __init__(self, known: dict[tuple[str, str], dict[str, int]]):
        self.known = known
        self.open: dict[tuple[str, str], None] = {}

    def ask(self, kind: str, text: str) -> dict[str, int]:
        got = self.known.get((kind, text))
        if got is None:
            self.open[kind, text] = None
        return got or {}


#: Entries of a list that each worker holds as one trie, and of a block of a longer list.
MOST_ENTRIES = 50_000


def _blocks(reference: DataFrame, size: int) -> Iterator[list[tuple[str, str, str]]]:
    """The entries (code, name, symbol) in blocks of at most `size`, in the order of their codes."""
    block: list[tuple[str, str, str]] = []
    for r in reference.select("code", "name", "symbol").where("code <> ''").orderBy("code").toLocalIterator():
        block.append((r["code"], r["name"] or "", r["symbol"] or ""))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


def within(values: DataFrame, value: str, reference: DataFrame, aliases: str = CURRENCY_ALIASES, size: int = MOST_ENTRIES) -> DataFrame:
    """(value, code, distance): for each distinct value all entries of which a path is within its distance.

    Paths are codes, names and aliases, folded; the distance allowed grows with the folded value's length. A list of
    more than `size` entries is taken block by block; the driver and the workers hold one block.
    """
    ship(values.sparkSession)
    asked = values.select(F.col(f"`{value}`").cast("string").alias("value")).where("value <> ''").distinct()
    out = None
    for block in _blocks(reference, size):

        def run(batches: Iterator[pd.DataFrame], block: list = block) -> Iterator[pd.DataFrame]:
            trie = Matcher(block, aliases).trie
            for b in batches:
                rows = [(v, c, d) for v, w in zip(b["value"], map(fold, b["value"])) for c, d in trie.search(w, allowed(len(w))).items()]
                yield pd.DataFrame(rows, columns=["value", "code", "distance"])

        part = asked.mapInPandas(run, "value string, code string, distance int")
        out = part if out is None else out.unionByName(part)
    return asked.sparkSession.createDataFrame([], "value string, code string, distance int") if out is None else out


FOUND = "array<struct<code: string, distance: int>>"


def _judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(value, code, kind, text): the code of a value whose questions are all answered, else a row for each open question."""
    for b in batches:
        rows = []
        for value, answers in zip(b["value"], b["answers"]):
            rules = Told({(a["kind"], a["text"]): {f["code"]: f["distance"] for f in a["found"]} for a in answers})
            code = rules._one(rules._fits(value))
            rows += [(value, None, k, t) for k, t in rules.open] or [(value, code, None, None)]
        yield pd.DataFrame(rows, columns=["value", "code", "kind", "text"])


def _codes_by_blocks(values: DataFrame, reference: DataFrame, aliases: str, size: int) -> DataFrame:
    """(value, code) of distinct values by a list that no worker holds whole.

    In rounds: the rules run on the answers so far, the distinct open questions go through all blocks, and the answers
    come back to the values that asked. The words of a value are all asked about in the first round, so that a few
    rounds are enough; it ends when no value has an open question.
    """
    ship(values.sparkSession)
    none = F.array().cast(f"array<struct<kind: string, text: string, found: {FOUND}>>")
    todo = values.withColumn("answers", none)
    done = None
    while True:
        judged = cut(todo.mapInPandas(_judge, "value string, code string, kind string, text string"))
        part = judged.where("kind is null").select("value", "code")
        done = part if done is None else done.unionByName(part)
        ask = judged.where("kind is not null").select("value", "kind", "text")
        if ask.isEmpty():
            return done
        questions = cut(ask.select("kind", "text").distinct())
        found = questions.select("kind", "text", F.lit(None).cast("string").alias("code"), F.lit(None).cast("int").alias("distance"))
        for block in _blocks(reference, size):

            def run(batches: Iterator[pd.DataFrame], block: list = block) -> Iterator[pd.DataFrame]:
                matcher = Matcher(block, aliases)
                for b in batches:
                    rows = [(k, t, c, d) for k, t in zip(b["kind"], b["text"]) for c, d in matcher.ask(k, t).items()]
                    yield pd.DataFrame(rows, columns=["kind", "text", "code", "distance"])

            found = found.unionByName(questions.mapInPandas(run, "kind string, text string, code string, distance int"))
        # a code may stand in several blocks: the least of its distances
        found = found.groupBy("kind", "text", "code").agg(F.min("distance").alias("distance"))
        one = F.when(F.col("code").isNotNull(), F.struct("code", "distance"))
        answered = found.groupBy("kind", "text").agg(F.collect_list(one).cast(FOUND).alias("found"))
        new = ask.join(answered, ["kind", "text"]).groupBy("value").agg(F.collect_list(F.struct("kind", "text", "found")).alias("new"))
        todo = cut(todo.join(new, "value").select("value", F.concat("answers", "new").alias("answers")))


def map_values(rows: DataFrame, row_id: str, value: str, src: str, reference: DataFrame, aliases: str = CURRENCY_ALIASES, size: int = MOST_ENTRIES) -> DataFrame:
    """(src, row_id, code) of the non-empty values that are not exactly a code.

    reference (code, name, symbol) is the canonical list. A list of up to `size` entries is a trie in each worker: one
    pass, no shuffle; equal values are looked up once for each worker. A longer list is asked block by block. The rules
    are the same for both, so `size` changes no result.
    """
    asked = rows.select(F.col(row_id).cast("bigint").alias("row_id"), F.col(f"`{value}`").alias("value")).where("value <> ''")
    first = reference.select("code", "name", "symbol").where("code <> ''").limit(size + 1).collect()
    if len(first) > size:
        codes = reference.select(F.col("code").alias("value")).where("value <> ''").distinct()
        left = asked.join(codes, "value", "left_anti")
        of = _codes_by_blocks(left.select("value").distinct(), reference, aliases, size)
        return left.join(of, "value").select(F.lit(src).alias("src"), "row_id", "code")
    entries = [(r["code"], r["name"] or "", r["symbol"] or "") for r in first]
    ship(rows.sparkSession)
    kept: dict[str, Matcher] = {}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = kept.setdefault("m", Matcher(entries, aliases))
        for b in batches:
            yield pd.DataFrame({"src": src, "row_id": b["row_id"], "code": [m.code(v) for v in b["value"]]})

    codes = {e[0] for e in entries}
    known = F.col("value").isin(sorted(codes)) if len(codes) <= 1_000 else None
    if known is None:
        asked = asked.join(reference.select(F.col("code").alias("value")).distinct(), "value", "left_anti")
    else:
        asked = asked.where(~known)
    return asked.mapInPandas(run, "src string, row_id bigint, code string")
